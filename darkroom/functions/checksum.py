"""MD5 of file content for the rows that need it (planned uploads only).

Reading file bytes is I/O, not a SQL expression; it runs on the executors in
Arrow batches (`mapInPandas`), each file read in fixed-size chunks so memory
stays constant. NULL when the file cannot be read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_CHUNK = 1 << 20


def _md5(path: str):
    digest = hashlib.md5()
    try:
        with open(path, "rb") as fh:
            for chunk in iter(lambda: fh.read(_CHUNK), b""):
                digest.update(chunk)
    except (OSError, TypeError):
        return None
    return digest.hexdigest()


def with_checksum(
    df: DataFrame, path_col: str = "file_path", out_col: str = "md5_checksum", spread: bool = True
) -> DataFrame:
    """Add (or replace) `out_col` with the MD5 of the file at `path_col`.

    Rows arrive partitioned as the listing made them (one folder per task),
    so a folder holding a third of the files would be read by one task. With
    `spread`, rows are first hash-partitioned by path into
    `spark.sql.shuffle.partitions` parts. That shuffle moves small rows while
    the hashing reads whole files. An explicit count is kept as it is by AQE,
    which would otherwise merge the small rows into a few tasks."""
    base = df.drop(out_col) if out_col in df.columns else df
    if spread:
        parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions") or "200")
        base = base.repartition(parts, path_col)
    schema = T.StructType(list(base.schema.fields) + [T.StructField(out_col, T.StringType())])

    def run(batches):
        for pdf in batches:
            pdf[out_col] = [_md5(p) for p in pdf[path_col]]
            yield pdf

    return base.mapInPandas(run, schema)
