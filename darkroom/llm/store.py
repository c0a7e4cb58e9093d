"""Intermediate tables of the operators, in the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from darkroom.session import checkpoint_dir

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once under `spark.checkpoint.dir` and read it back.

    Later steps then start from files that survive a lost executor. The write's
    own shuffle files are dropped as soon as it ends (`CLEAN_UP`, set for this
    one write only), so disk holds one step's shuffle at a time."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more: what was made of them
    is itself stored."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as
    `spark-submit --py-files` would, so that Python tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_darkroom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="darkroom-py-"), "darkroom.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._darkroom_shipped = True
