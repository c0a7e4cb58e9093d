"""Corpus pipeline: quality rules, near duplicates, repeated passages, source mix, packing.

Each stage takes all rows that the stage before it kept and calls one operator
of `darkroom.llm`. All but the last return the columns of `documents`. A stage
is written as Parquet in the shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from darkroom.llm.best_fit_packing import pack_documents
from darkroom.llm.lsh_forest import one_per_class
from darkroom.llm.quality_rules import quality_rules
from darkroom.llm.repeated_passages import remove_repeats
from darkroom.llm.source_mix import mix_sources
from darkroom.llm.store import ship_package, stored


def carried(docs: DataFrame, *read: str, leave: str | None = None) -> DataFrame:
    """The columns that an operator reads, and all (but `leave`) as one struct, so
    that no column of the documents gives way to a result of the same name."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != leave]).alias("own_row"), *read)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(carried(docs, "doc_id", "text"), labels, keep=["own_row"]).where("kept").select("own_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the least doc_id."""
    ship_package(spark)
    left = one_per_class(carried(docs, "doc_id", "text", leave="text"))
    return left.select(*[F.col("text") if c == "text" else F.col("own_row")[c].alias(c) for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur elsewhere too."""
    ship_package(spark)
    left = remove_repeats(carried(docs, "text", leave="text"), keep=["own_row", "text"])
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.select(*[new.get(c, F.col("own_row")[c]).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its first word: up to twice."""
    # The mix runs on keys, so that texts move once: equal keys are equal rows.
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*own).alias("_row"), F.xxhash64(*own, F.lit(1)).alias("_k1"), F.xxhash64(*own, F.lit(2)).alias("_k2"))
    rows = keyed.select("_k1", "_k2", "_row.doc_id", "_row.text", "_row.source")
    taken = mix_sources(rows, keep=["_k1", "_k2"]).where("passes > 0")
    times = taken.groupBy(F.col("_k1").alias("_t1"), F.col("_k2").alias("_t2")).agg(F.sum("passes").alias("_times"))
    found = keyed.join(times, (F.col("_k1") == F.col("_t1")) & (F.col("_k2") == F.col("_t2")))
    once = found.withColumn("_n", F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(0)))).where("_n = 1")
    return once.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_")).select("_row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    ship_package(spark)
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Hash n-gram scores, MinHash tries, byte windows and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole `documents` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
