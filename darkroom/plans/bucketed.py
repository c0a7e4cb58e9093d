"""Tables bucketed and sorted by their key, so that merges do not shuffle them.

A catalogue or ledger holds far more rows than a run adds. Written with Spark's
`bucketBy`, its files say which keys they hold: a join on the key reads bucket i
in task i, and only the run's rows are shuffled to the buckets. The merged rows
come out bucket by bucket, so each task writes the one new file of its bucket.

The table's description (key, number of buckets) travels with the caller; the
session catalogue gets an external table over the folder. Dropping that leaves
the files. All versions of a table should use one number of buckets: Spark
shuffles the side that differs.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEY = "file_path"


def _table(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def _named(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_bucketed(df: DataFrame, path: str, buckets: int, key: str = KEY) -> str:
    """Write `df` to the new folder `path`, bucketed and sorted by `key`."""
    name = _table(path)
    df.write.format("parquet").mode("error").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return path


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int, key: str = KEY) -> DataFrame:
    """The table at `path`, known to Spark as bucketed. Any session may read it."""
    name = _table(path)
    columns = ", ".join(f"{_named(f.name)} {f.dataType.simpleString()}" for f in schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({_named(key)}) SORTED BY ({_named(key)}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def forget(spark: SparkSession, path: str) -> None:
    """Take the table out of the session catalogue; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
