"""Incremental runs with Structured Streaming.

The scripts re-run on a schedule (catalogue every 30 min, stacking every
2 h). Here each run is an `availableNow` trigger over a landing folder: only
files not seen before are read, each micro-batch merges into the snapshot
table and writes the next version of the sequence that batch jobs share. The
version's commit names the stream and batch, so a replayed batch is known.

Notes:
- a landed file is offered once even if rewritten later; retries of
  incomplete catalogue rows stay with the batch job (`jobs.run_catalogue`);
- stacking has no watermark: a late partner may come at any time, and an
  already stacked asset is never regrouped (stacked assets are filtered out
  first, as in the scripts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from darkroom import schemas
from darkroom.operators import merge, metadata, stacks
from darkroom.plans.jobs import stacked_assets
from darkroom.plans.snapshots import has_tag, latest_version, next_version, read_version, write_version
from darkroom.session import materialize
from darkroom.sources.json_records import ASSET_PAGE_SCHEMA


def _landed_text(spark: SparkSession, landing_dir: str) -> DataFrame:
    return (
        spark.readStream.format("text").option("wholetext", "true").load(landing_dir)
        .select(
            F.col("_metadata.file_path").alias("landed_path"), "value",
            F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")).alias("landed_at"),
        )
    )


def stream_catalogue(spark: SparkSession, landing_dir: str, catalogue_base: str, checkpoint: str, run_ts: str):
    """Merge newly landed EXIF records into the catalogue, one version per batch."""
    def batch(df: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if has_tag(spark, catalogue_base, tag):
            return
        rec = F.get_json_object("value", "$[0]")
        records = df.select(
            F.coalesce(F.get_json_object(rec, "$.SourceFile"), F.col("landed_path")).alias("file_path"),
            rec.alias("metadata_json"), "landed_at",
        ).where(F.col("metadata_json").isNotNull() & (F.regexp_replace("metadata_json", r"\s", "") != "{}"))
        current = read_version(spark, catalogue_base, latest_version(spark, catalogue_base), schemas.CATALOGUE)
        incoming = merge.resolve_records(metadata.exif_fields(records, keep=("landed_at",)), "landed_at")
        merged = metadata.with_taken_month(merge.merge_catalogue(current, incoming, run_ts))
        write_version(merged, catalogue_base, next_version(spark, catalogue_base), ("taken_month",), tag)

    query = (
        _landed_text(spark, landing_dir).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def stream_stacks(spark: SparkSession, landing_dir: str, state_base: str, plans_base: str, checkpoint: str):
    """Stack newly landed assets together with the stored unstacked ones.
    Only keys touched by the batch are regrouped (a semi-join on the key)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if has_tag(spark, state_base, tag):
            return
        # An asset listed several times in a batch: its latest listing.
        landed = (
            df.select("landed_at", F.from_json("value", ASSET_PAGE_SCHEMA).alias("p"))
            .select("landed_at", F.posexplode("p.assets.items").alias("at", "a"))
            .groupBy("a.id").agg(F.max_by("a", F.struct("landed_at", "at")).alias("a"))
            .select(
                F.col("a.id").alias("asset_id"), F.col("a.originalFileName").alias("original_file_name"),
                F.col("a.localDateTime").alias("local_date_time"), F.col("a.stackCount").alias("stack_count"),
            )
        )
        state = read_version(spark, state_base, latest_version(spark, state_base), schemas.ASSETS)
        # Latest listing of an asset wins, but a late one never clears a stored stack mark.
        marks = state.select(F.col("asset_id").alias("_id"), F.col("stack_count").alias("_mark"))
        new = landed.join(marks, F.col("asset_id") == F.col("_id"), "left").withColumn("stack_count", F.greatest("stack_count", "_mark").cast("int")).drop("_id", "_mark")
        new = materialize(new, "stack-landed")
        merged = state.join(new.select("asset_id"), "asset_id", "left_anti").unionByName(new)
        keys = stacks.stack_candidates(new).select(*stacks.KEY).distinct()
        touched = stacks.stack_candidates(merged).join(keys, list(stacks.KEY), "left_semi").select("asset_id")
        # Both outputs read the scope; stored once so the state is scanned once.
        scope = materialize(merged.join(touched, "asset_id", "left_semi"), "stack-scope")
        if not has_tag(spark, plans_base, tag):
            write_version(stacks.stack_requests(scope), plans_base, next_version(spark, plans_base), tag=tag)
        updated = stacked_assets(scope)
        rest = merged.join(touched, "asset_id", "left_anti")
        write_version(rest.unionByName(updated), state_base, next_version(spark, state_base), tag=tag)

    query = (
        _landed_text(spark, landing_dir)
        .writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
