"""Stacking of newly landed assets with keyed state.

`incremental.stream_stacks` keeps all assets as a snapshot and writes the next
one per micro-batch. Here the memory of past runs is state of Spark's own store,
keyed by (base name, capture time), so a batch reads and writes only the keys it
touches, however many assets came before.

A key remembers the assets that wait for a partner and the ids that are stacked.
More than one waiting asset makes a stack, so after a batch at most one is left
waiting. Every listing of an asset goes to its key:

- an id that is stacked already (asked for by an earlier run, or marked by its
  listing) is never asked for again;
- of several listings of a waiting asset the latest gives its name;
- a listing with a stack mark takes a waiting asset out.

Rows of a key stream through its task in Arrow batches and live in the state
store, not in lists, so a key with very many assets needs time but no memory.
Request bodies are built from the batch's members by `stacks.stack_requests`,
whose ranking is split for hot keys. If a stack of an earlier batch gets more
partners later, these are stacked among themselves, as the scripts do: a stacked
asset is never regrouped.

An asset that is listed under another name or time before it is stacked is a new
member there, while its old key keeps the old listing; use `stream_stacks` where
names or times of landed assets change. Assets without id, base name or time are
left out. Empty pages give nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from darkroom.functions.names import stem
from darkroom.operators import stacks
from darkroom.plans.snapshots import has_tag, next_version, write_version
from darkroom.session import materialize
from darkroom.sources.json_records import ASSET_PAGE_SCHEMA
from darkroom.streaming.incremental import _landed_text

MEMBER = "base_name string, local_date_time string, asset_id string, original_file_name string"
#: Rows of one output batch of a key.
OUT_ROWS = 10_000
#: What keyed state of this kind needs: the store that holds several variables
#: per key, and commits that upload the batch's changes instead of the whole store.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class WaitingAssets(StatefulProcessor):
    """State of one (base name, capture time)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getMapState("waiting", "asset_id string", "original_file_name string, listed string")
        self.stacked = handle.getMapState("stacked", "asset_id string", "known boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for asset, name, listed, marked in zip(batch["asset_id"], batch["original_file_name"], batch["listed"], batch["marked"], strict=True):
                if self.stacked.containsKey((asset,)):
                    continue
                if marked:
                    self.stacked.updateValue((asset,), (True,))
                    if self.waiting.containsKey((asset,)):
                        self.waiting.removeKey((asset,))
                elif not self.waiting.containsKey((asset,)) or self.waiting.getValue((asset,))[1] <= listed:
                    self.waiting.updateValue((asset,), (name, listed))
        if not self._several():
            return
        members: list[tuple] = []
        for (asset,), (name, _) in self.waiting.iterator():
            members.append((*key, asset, name))
            if len(members) == OUT_ROWS:
                yield self._stack(members)
                members = []
        if members:
            yield self._stack(members)
        self.waiting.clear()

    def _several(self) -> bool:
        found = 0
        for _ in self.waiting.keys():
            found += 1
            if found > 1:
                return True
        return False

    def _stack(self, members: list[tuple]) -> pd.DataFrame:
        for m in members:
            self.stacked.updateValue((m[2],), (True,))
        return pd.DataFrame(members, columns=["base_name", "local_date_time", "asset_id", "original_file_name"])

    def close(self) -> None:
        pass


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def landed_assets(pages: DataFrame) -> DataFrame:
    """One row per listed asset with a usable key: KEY, asset_id,
    original_file_name, listed (a text that orders listings), marked."""
    items = pages.select("landed_at", F.from_json("value", ASSET_PAGE_SCHEMA).alias("p")).select("landed_at", F.posexplode("p.assets.items").alias("at", "a"))
    name = F.coalesce(F.col("a.originalFileName"), F.lit(""))
    when = F.unix_micros(F.col("landed_at.file_modification_time"))
    listed = F.concat_ws("|", F.lpad(when.cast("string"), 20, "0"), F.col("landed_at.file_path"), F.lpad(F.col("at").cast("string"), 10, "0"))
    return items.select(
        stem(name).alias("base_name"), F.coalesce(F.col("a.localDateTime"), F.lit("")).alias("local_date_time"),
        F.col("a.id").alias("asset_id"), name.alias("original_file_name"), listed.alias("listed"),
        (F.coalesce(F.col("a.stackCount"), F.lit(0)) != 0).alias("marked"),
    ).where((F.col("base_name") != "") & (F.col("local_date_time") != "") & F.col("asset_id").isNotNull())


def stream_stacks_keyed(spark: SparkSession, landing_dir: str, plans_base: str, checkpoint: str):
    """One run over the asset pages that landed since the last one: a version of
    stack requests per micro-batch that has any. The state is in `checkpoint`."""
    def batch(df: DataFrame, batch_id: int) -> None:
        # Always read to its end, also in a replay: reading it commits the state.
        members = materialize(df, "stack-new-members")
        tag = f"{checkpoint}#{batch_id}"
        if members.isEmpty() or has_tag(spark, plans_base, tag):
            return
        requests = stacks.stack_requests(members.withColumn("stack_count", F.lit(None).cast("int")))
        write_version(requests, plans_base, next_version(spark, plans_base), tag=tag)

    with _settings(spark, STATE_SETTINGS):
        found = landed_assets(_landed_text(spark, landing_dir)).groupBy(*stacks.KEY).transformWithStateInPandas(
            WaitingAssets(), outputStructType=MEMBER, outputMode="Append", timeMode="None")
        query = found.writeStream.foreachBatch(batch).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query
