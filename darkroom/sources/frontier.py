"""Listing of folder trees in rounds on the executors.

A round reads the folders that the round before found: the frontier, spread
over the tasks by a hash of the path. The driver knows the roots only, and runs
as many rounds as the tree is deep. A round takes names and entry kinds, no file
attributes; these are read in a last pass over all files, spread likewise, so a
single folder that holds every file is examined by many tasks. Each round is
stored, so a lost executor repeats its share of one round.

As in `media_files`: a missing root has no rows (it is reported), a folder that
cannot be read is an error, a link to a file is listed like the file unless
`links` is false, linked folders are not entered, and a file that goes while the
tree is read is left out. The roots must be on storage every executor sees.
"""

from __future__ import annotations

import datetime as _dt
import os
import stat
import sys
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from darkroom.session import materialize

ENTRIES = "root string, path string, folder boolean"
FILES = "root string, path string, modified timestamp_ntz, length long"
_ENTRIES = pa.schema([("root", pa.string()), ("path", pa.string()), ("folder", pa.bool_())])
_FILES = pa.schema([("root", pa.string()), ("path", pa.string()), ("modified", pa.timestamp("us")), ("length", pa.int64())])
#: Rows of an output batch: what a task holds of a folder, however large.
BATCH = 10_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over `spark.sql.shuffle.partitions` tasks; an explicit count, as
    the rows are small and the work behind each is not, so AQE leaves it alone."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions") or "200"), key)


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        yield from zip(batch.column("root").to_pylist(), batch.column("path").to_pylist(), strict=True)


def read_folders(folders: DataFrame, exclude: Sequence[str] = (), links: bool = True) -> DataFrame:
    """The entries of each folder (root, path): a row each, with its own path."""
    pruned = frozenset(exclude)

    def entries(root: str, top: str) -> Iterator[tuple[str, str, bool]]:
        with os.scandir(top) as found:
            for e in found:
                if e.is_dir(follow_symlinks=False):
                    if e.name not in pruned:
                        yield root, e.path, True
                elif links or not e.is_symlink():
                    yield root, e.path, False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched((row for root, top in _pairs(batches) for row in entries(root, top)), _ENTRIES)

    return folders.select("root", "path").mapInArrow(run, ENTRIES)


def list_entries(
    spark: SparkSession, roots: Sequence[str], exclude: Sequence[str] = (), links: bool = True, recursive: bool = True,
) -> DataFrame:
    """(root, path, folder) of everything below the roots, the roots included."""
    tops = []
    for root in roots:
        if os.path.isdir(root):
            tops.append((os.path.abspath(root),) * 2)
        else:
            print(f"listing: root does not exist, skipped: {root}", file=sys.stderr)
    found = spark.createDataFrame([(*t, True) for t in tops], ENTRIES)
    frontier = found
    while not frontier.isEmpty():
        entries = materialize(read_folders(spread(frontier, "path"), exclude, links), "listing-round")
        found = found.unionByName(entries)
        if not recursive:
            break
        frontier = entries.where("folder")
    return found


def with_attributes(entries: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """(root, path, modified, length) of the regular files among the entries; with
    `suffixes` (any case) no others are looked at."""
    files = entries.where("NOT folder")
    if suffixes:
        ends = [F.lower("path").endswith(s.lower()) for s in suffixes]
        files = files.where(F.array_contains(F.array(*ends), True))

    def attributes(root: str, path: str) -> tuple | None:
        try:
            st = os.stat(path)  # of the file that a link names
        except FileNotFoundError:
            return None
        if not stat.S_ISREG(st.st_mode):
            return None
        return root, path, _dt.datetime.fromtimestamp(st.st_mtime, _dt.timezone.utc).replace(tzinfo=None), st.st_size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched((row for root, path in _pairs(batches) if (row := attributes(root, path))), _FILES)

    return spread(files.select("root", "path"), "path").mapInArrow(run, FILES)


def list_tree(
    spark: SparkSession, roots: Mapping[str, str] | Sequence[str], exclude: Sequence[str] = (), links: bool = True,
    suffixes: Sequence[str] = (), recursive: bool = True,
) -> DataFrame:
    """The files below the roots with the columns of `media_files.list_media`
    (`md5_checksum` is NULL; `with_checksum` hashes planned files). The folders
    are read now, the files' attributes when the result is."""
    tags = dict(roots) if isinstance(roots, Mapping) else {}
    paths = list(tags.values()) if tags else list(roots)
    files = with_attributes(list_entries(spark, paths, exclude, links, recursive), suffixes)
    out = files.select(
        "root", F.col("path").alias("file_path"), "modified", F.col("length").alias("file_size"),
        F.lit(None).cast("string").alias("md5_checksum"))
    if isinstance(roots, Mapping):
        tag = F.lit(None).cast("string")
        for source_type, root in reversed(tags.items()):  # the first of equal roots wins
            tag = F.when(F.col("root") == os.path.abspath(root), F.lit(source_type)).otherwise(tag)
        out = out.withColumn("source_type", tag)
    return out
