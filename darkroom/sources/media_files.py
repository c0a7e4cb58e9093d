"""`media_files`: a Python Data Source listing files below one or more roots.

Why not `binaryFile`: Spark's file sources skip names starting with '_' or
'.', and cameras write `_DSC1234.NEF`; a deletion sync built on them would
see those files as deleted. This source lists every regular file.

Layout of the work:
- the driver only lists each root's first level (bounded by its fan-out):
  one unit per sub-directory plus one for files directly in the root
  (`split_depth` cuts so many levels deep: 3 gives a task per day folder of a
  YYYY/MM/DD tree); `max_partitions` deals units into fewer tasks;
- each executor walks its own sub-tree, skips excluded directory names before
  descending, and optionally computes the MD5 of the content in fixed-size
  chunks (constant memory);
- a missing root yields no partition (it is reported, not an error);
- a folder that cannot be read is an error, never an empty folder;
- a symbolic link to a file is listed like the file (as `Path.is_file()`
  does) unless `links` is 'false'; linked directories are not descended into.
The roots must be on storage every executor sees (a shared mount).

Options: `paths` (roots joined by the path separator `os.pathsep`),
`exclude` (comma-separated directory names to prune), `checksum` ('true'
to fill `md5`), `split_depth` (levels, default '1'), `max_partitions`
(directories are dealt round-robin into this many tasks; default one each),
`links` ('false' lists regular files only).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "root string, path string, modified timestamp_ntz, length bigint, md5 string"
_CHUNK = 1 << 20


class _Dir:
    def __init__(self, root: str, start: str, recursive: bool):
        self.root = root
        self.start = start
        self.recursive = recursive


class _Part(InputPartition):
    """A group of directories walked by one task."""

    def __init__(self, dirs: list[_Dir]):
        super().__init__(len(dirs))
        self.dirs = dirs


def _md5(path: str) -> str | None:
    digest = hashlib.md5()
    try:
        with open(path, "rb") as fh:
            for chunk in iter(lambda: fh.read(_CHUNK), b""):
                digest.update(chunk)
    except OSError:
        return None
    return digest.hexdigest()


def _fail(error: OSError) -> None:
    """A folder that cannot be read fails its task: a listing without it would
    make its files look deleted."""
    raise error


class MediaFilesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.roots = [p for p in options.get("paths", "").split(os.pathsep) if p]
        self.exclude = {e for e in options.get("exclude", "").split(",") if e}
        self.checksum = options.get("checksum", "false").lower() == "true"
        self.links = options.get("links", "true").lower() == "true"
        self.depth = int(options.get("split_depth", "1"))
        self.max_partitions = int(options.get("max_partitions", "0"))

    def _dirs(self, root: str, top: str, depth: int) -> list[_Dir]:
        parts = [_Dir(root, top, False)]  # files directly in `top`
        for e in sorted(os.scandir(top), key=lambda e: e.name):
            if e.is_dir(follow_symlinks=False) and e.name not in self.exclude:
                if depth > 1:
                    parts.extend(self._dirs(root, e.path, depth - 1))
                else:
                    parts.append(_Dir(root, e.path, True))
        return parts

    def partitions(self):
        dirs: list[_Dir] = []
        for root in self.roots:
            if not os.path.isdir(root):
                print(f"media_files: root does not exist, skipped: {root}", file=sys.stderr)
                continue
            top = os.path.abspath(root)  # paths come out absolute, as the jobs key them
            dirs.extend(self._dirs(top, top, self.depth))
        if not dirs:
            return [_Part([])]
        # One task per directory, or `max_partitions` tasks dealt round-robin.
        n = min(self.max_partitions or len(dirs), len(dirs))
        return [_Part(dirs[i::n]) for i in range(n)]

    def _row(self, root: str, path: str):
        try:
            st = os.stat(path)  # a link to a file counts as that file (size of the target)
        except FileNotFoundError:  # went while the folder was read (or a link to nothing)
            return None
        modified = _dt.datetime.fromtimestamp(st.st_mtime, _dt.timezone.utc).replace(tzinfo=None)
        return (root, path, modified, st.st_size, _md5(path) if self.checksum else None)

    def _wanted(self, path: str) -> bool:
        return os.path.isfile(path) and (self.links or not os.path.islink(path))

    def read(self, partition: _Part):
        for d in partition.dirs:
            yield from self._read_dir(d)

    def _read_dir(self, d: _Dir):
        if not d.recursive:
            for e in sorted(os.scandir(d.start), key=lambda e: e.name):
                if self._wanted(e.path):
                    row = self._row(d.root, e.path)
                    if row:
                        yield row
            return
        for top, subdirs, files in os.walk(d.start, onerror=_fail):
            subdirs[:] = sorted(x for x in subdirs if x not in self.exclude)
            for name in sorted(files):
                path = os.path.join(top, name)
                if self._wanted(path):
                    row = self._row(d.root, path)
                    if row:
                        yield row


class MediaFilesDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "media_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MediaFilesReader:
        return MediaFilesReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MediaFilesDataSource)


def list_media(
    spark: SparkSession,
    roots: dict[str, str] | list[str],
    checksum: bool = False,
    exclude: tuple[str, ...] = (),
    split_depth: int = 3,
    links: bool = True,
) -> DataFrame:
    """File listing of the roots: root, file_path, modified, file_size, md5
    (and source_type when `roots` maps tags to directories)."""
    register(spark)
    paths = list(roots.values()) if isinstance(roots, dict) else list(roots)
    df = (
        spark.read.format("media_files")
        .option("paths", os.pathsep.join(paths))
        .option("exclude", ",".join(exclude))
        .option("checksum", str(checksum).lower())
        .option("split_depth", str(split_depth))
        .option("links", str(links).lower())
        .load()
        .select("root", F.col("path").alias("file_path"), "modified", F.col("length").alias("file_size"),
                F.col("md5").alias("md5_checksum"))
    )
    if isinstance(roots, dict):
        tag = None
        for source_type, root in roots.items():
            cond = F.col("root") == os.path.abspath(root)
            tag = F.when(cond, F.lit(source_type)) if tag is None else tag.when(cond, F.lit(source_type))
        df = df.withColumn("source_type", tag)
    return df
