"""Readers for JSON that the photo-server jobs land as files.

- EXIF records: one file per image holding the extractor's output, a JSON
  array whose first element is the record;
- asset pages: the search API's `{"assets": {"items": [...], "nextPage": ...}}`
  pages, one file per page (all pages of a run together are the listing);
- library lists: a JSON array of `{id, name, type}` objects.

Spark's file sources skip names starting with '_' or '.', so landed files must
not use such names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.constants import LIBRARY_DEFAULT_NAME, LIBRARY_UPLOAD

ASSET_PAGE_SCHEMA = T.StructType([
    T.StructField("assets", T.StructType([
        T.StructField("items", T.ArrayType(T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("originalFileName", T.StringType()),
            T.StructField("localDateTime", T.StringType()),
            T.StructField("stackCount", T.IntegerType()),
        ]))),
        T.StructField("nextPage", T.StringType()),
    ])),
])


def read_exif_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) from landed extractor output. A record is the first
    element of the file's array; an empty object, an empty array or text that
    is not JSON is rejected (the scripts skip such files with a warning).
    file_path is the record's SourceFile, else the landed file's path;
    landed_at orders records by landing time, then by name."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("landed_path"), F.col("value"),
        F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")).alias("landed_at"),
    )
    rec = F.get_json_object("value", "$[0]")
    parsed = raw.select("landed_path", "landed_at", rec.alias("metadata_json"))
    ok = F.col("metadata_json").isNotNull() & (F.regexp_replace("metadata_json", r"\s", "") != "{}")
    records = parsed.where(ok).select(
        F.coalesce(F.get_json_object("metadata_json", "$.SourceFile"), F.col("landed_path")).alias("file_path"),
        "metadata_json", "landed_at",
    )
    rejects = parsed.where(~ok | F.col("metadata_json").isNull()).select("landed_path")
    return records, rejects


def read_asset_pages(spark: SparkSession, path: str) -> DataFrame:
    """Flattened asset listing (asset_id, original_file_name, local_date_time,
    stack_count) from landed search pages."""
    pages = spark.read.schema(ASSET_PAGE_SCHEMA).option("multiLine", "true").json(path)
    return pages.select(F.explode("assets.items").alias("a")).select(
        F.col("a.id").alias("asset_id"),
        F.col("a.originalFileName").alias("original_file_name"),
        F.col("a.localDateTime").alias("local_date_time"),
        F.col("a.stackCount").alias("stack_count"),
    )


def read_libraries(spark: SparkSession, path: str) -> DataFrame:
    """Library list (id, name, type) with defaults by key *absence*: a missing
    `type` is 'UPLOAD', a missing `name` is 'Unnamed'; a present null stays NULL."""
    text = spark.read.text(path, wholetext=True)
    libs = text.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("m"))

    def member(key: str, default: str):
        return F.when(F.map_contains_key("m", key), F.element_at("m", F.lit(key))).otherwise(F.lit(default))

    return libs.select(
        F.element_at("m", F.lit("id")).alias("id"),
        member("name", LIBRARY_DEFAULT_NAME).alias("name"),
        member("type", LIBRARY_UPLOAD).alias("type"),
    )


def libraries_to_scan(libraries: DataFrame, external_only: bool = False) -> DataFrame:
    """Libraries whose scan is triggered; external-only skips 'UPLOAD'."""
    if not external_only:
        return libraries
    return libraries.where(~F.col("type").eqNullSafe(F.lit(LIBRARY_UPLOAD)))
