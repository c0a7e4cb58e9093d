"""Manifest of landed extractor output: which file holds which image's record.

Landed JSON is one small file per image. A run lists the landing folder (names,
times and sizes; no file is opened) and compares it with the manifest, an
append-only table that holds the record of every file seen so far. Only new and
rewritten files are opened, by tasks that the paths are spread over; what they
hold is appended as one version, many files bundled into few. Runs then read
records from the manifest, columns pruned, instead of the landed files.

A file is known by path, time and size. One that is put back to an earlier
content and time counts as changed again; one that is gone keeps its manifest
row, but gives no record. Names that start with '_' or '.' are not landed files.
"""

from __future__ import annotations

import pathlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.plans.snapshots import next_version, read_all, write_version
from darkroom.session import materialize
from darkroom.sources.frontier import batched, list_tree, spread

KEY = ["landed_path", "landed_time", "landed_size"]
MANIFEST = T.StructType([
    T.StructField("landed_path", T.StringType()), T.StructField("landed_time", T.TimestampNTZType()),
    T.StructField("landed_size", T.LongType()), T.StructField("file_path", T.StringType()),
    T.StructField("metadata_json", T.StringType()),
])
_TEXTS = pa.schema([("landed_path", pa.string()), ("landed_time", pa.timestamp("us")), ("landed_size", pa.int64()), ("value", pa.string())])


def landed_states(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """A row per path of either side, with the time and size found (of the
    manifest where none is) and its state: new, changed, known or gone."""
    seen = manifest.groupBy(F.col("landed_path").alias("_path")).agg(F.max(F.struct("landed_time", "landed_size")).alias("_seen"))
    here = F.struct("landed_time", "landed_size")
    state = (
        F.when(F.col("landed_path").isNull(), F.lit("gone")).when(F.col("_path").isNull(), F.lit("new"))
        .when(here == F.col("_seen"), F.lit("known")).otherwise(F.lit("changed")))
    return found.select(*KEY).join(seen, F.col("landed_path") == F.col("_path"), "full").select(
        F.coalesce("landed_path", "_path").alias("landed_path"),
        F.coalesce("landed_time", F.col("_seen.landed_time")).alias("landed_time"),
        F.coalesce("landed_size", F.col("_seen.landed_size")).alias("landed_size"), state.alias("state"))


def open_landed(files: DataFrame) -> DataFrame:
    """The manifest rows of landed files, each opened once. A file's record is
    the first element of its array; without one `metadata_json` is NULL."""
    def texts(batch: pa.RecordBatch) -> Iterator[tuple]:
        for path, time, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            try:
                with open(path, "rb") as fh:
                    yield path, time, size, fh.read().decode("utf-8", "replace")
            except FileNotFoundError:  # went since the listing
                continue

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):  # texts in memory at a time
                yield from batched(texts(batch.slice(start, 100)), _TEXTS)

    opened = spread(files.select(*KEY), "landed_path").mapInArrow(run, "landed_path string, landed_time timestamp_ntz, landed_size long, value string")
    record = opened.select(*KEY, F.get_json_object("value", "$[0]").alias("_record"))
    record = record.withColumn("metadata_json", F.when(F.regexp_replace("_record", r"\s", "") != "{}", F.col("_record")))
    return record.select(
        *KEY, F.coalesce(F.get_json_object("metadata_json", "$.SourceFile"), landed_uri("landed_path")).alias("file_path"), "metadata_json")


def landed_uri(path: str) -> F.Column:
    return F.concat(F.lit("file://"), F.col(path))


def landed_records(spark: SparkSession, landing_dir: str, base: str) -> tuple[DataFrame, DataFrame, int]:
    """(records, rejects, files opened) as `read_exif_json` gives them, by way of
    the manifest at `base`, which is brought up to date first."""
    landing_dir = str(pathlib.Path(landing_dir).absolute())
    found = list_tree(spark, [landing_dir], recursive=False).where(~F.regexp_extract("file_path", "[^/]*$", 0).rlike("^[_.]"))
    found = materialize(found.select(F.col("file_path").alias("landed_path"), F.col("modified").alias("landed_time"), F.col("file_size").alias("landed_size")), "landed-found")
    known = read_all(spark, base, MANIFEST)
    todo = materialize(landed_states(found, known).where(F.col("state").isin("new", "changed")), "landed-todo")
    opened = 0
    if not todo.isEmpty():
        seen = Observation("landed")
        rows = open_landed(todo).observe(seen, F.count(F.lit(1)).alias("n"))
        write_version(rows.hint("rebalance"), base, next_version(spark, base))
        opened = int(seen.get["n"])
    current = read_all(spark, base, MANIFEST).join(found, KEY, "left_semi")
    records = current.where("metadata_json IS NOT NULL").select(
        "file_path", "metadata_json", F.struct(F.col("landed_time").alias("file_modification_time"), F.col("landed_path").alias("file_path")).alias("landed_at"))
    rejects = current.where("metadata_json IS NULL").select(landed_uri("landed_path").alias("landed_path"))
    return records, rejects, opened
