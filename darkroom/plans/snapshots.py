"""Versioned snapshot tables on plain Parquet.

Plain Parquet has no MERGE or DELETE, so every run writes the next version of
a table into a folder of its own and never touches one that exists: a write
that dies half-way leaves a folder that no commit names. A version counts once
its row is in the table's log: (v, folder, tag, at). Spark's commit protocol
renames the row's file into place, so the row appears whole or not at all.
Batch and streaming runs share one sequence of versions; `tag` names the
micro-batch that wrote one, so that a replayed batch is recognised.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "v long, folder string, tag string, at long"


def _log_path(base: str) -> str:
    # '_'-prefixed: invisible to readers of the table, readable when named.
    return f"{base.rstrip('/')}/_versions"


def commits(spark: SparkSession, base: str) -> DataFrame | None:
    """The log of the table at `base`; None only if there is none yet. Any other
    trouble with it is an error: taking it for "no table" would lose the table."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(_log_path(base))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_version(
    df: DataFrame, base: str, version: int, partition_by: tuple[str, ...] = (), tag: str | None = None
) -> str:
    """Write `df` as version `version` of the table at `base` and commit it. A
    number that is committed already is refused: replacing it would lose the run
    that wrote it."""
    latest = latest_version(df.sparkSession, base)
    if latest is not None and version <= latest:
        raise ValueError(f"version {version} of {base} is committed already (latest: {latest})")
    path = f"{base.rstrip('/')}/v={version:012d}-{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("error").partitionBy(*partition_by)
    writer.parquet(path)
    row = [(version, path.rsplit("/", 1)[1], tag, time.time_ns())]
    df.sparkSession.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(_log_path(base))
    return path


def latest_version(spark: SparkSession, base: str, before: int | None = None) -> int | None:
    """Highest committed version at `base` (below `before` when given); None
    if none. One scalar comes back to the driver."""
    log = commits(spark, base)
    if log is None:
        return None
    if before is not None:
        log = log.where(F.col("v") < before)
    found = log.agg(F.max("v")).first()[0]
    return None if found is None else int(found)


def next_version(spark: SparkSession, *bases: str, at_least: int | None = None) -> int:
    """The number after every committed one of the tables `bases`, which are
    written together; `at_least` may ask for a higher one."""
    return max([at_least or 1, *((latest_version(spark, b) or 0) + 1 for b in bases)])


def version_of_tag(spark: SparkSession, base: str, tag: str) -> int | None:
    """The version that was committed with `tag`; None if there is none."""
    log = commits(spark, base)
    return None if log is None else log.where(F.col("tag") == tag).agg(F.max("v")).first()[0]


def has_tag(spark: SparkSession, base: str, tag: str) -> bool:
    log = commits(spark, base)
    return log is not None and not log.where(F.col("tag") == tag).isEmpty()


def version_path(spark: SparkSession, base: str, version: int) -> str:
    """Folder of a committed version (of its latest commit)."""
    log = commits(spark, base)
    folder = None if log is None else log.where(F.col("v") == version).agg(F.max_by("folder", "at")).first()[0]
    if folder is None:
        raise ValueError(f"no committed version {version} at {base}")
    return f"{base.rstrip('/')}/{folder}"


def read_version(spark: SparkSession, base: str, version: int | None, schema: T.StructType) -> DataFrame:
    """Version `version` of the table (an empty DataFrame of `schema` if None)."""
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(spark, base, version))


def read_all(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """All committed versions of an append-only table. One folder name per
    version comes back to the driver, as a file listing would."""
    log = commits(spark, base)
    folders = [] if log is None else [r["folder"] for r in log.groupBy("v").agg(F.max_by("folder", "at").alias("folder")).collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base.rstrip('/')}/{f}" for f in folders])
