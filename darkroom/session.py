"""Session and storage helpers.

Jobs never pick machine-local folders: lineage is cut by writing to the shared
folder the cluster names in `spark.checkpoint.dir`. Only tests and the local
bench set that option themselves, and only when it is unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("darkroom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", checkpoint_dir)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, read from `spark.checkpoint.dir`.

    A cluster must name it. Only a local-mode session (tests, the bench, a
    single machine) without the setting gets a private temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder for intermediate tables")
        path = tempfile.mkdtemp(prefix="darkroom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared checkpoint folder and read it back, so
    several outputs derive from one stored result (and a lost executor only
    re-reads files instead of recomputing the lineage)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
