"""Checked catalogue queries over `events` (fixture fx_exif) and their DuckDB
oracles. The oracle restates each rule in SQL on the typed fixture columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from darkroom.constants import METADATA_EXCLUDE_DIRS
from darkroom.functions.exif import clean_text, parse_exif_date
from darkroom.operators import merge, metadata
from darkroom.operators.listing import metadata_listing
from darkroom.plans.snapshots import write_version
from darkroom.session import checkpoint_dir, materialize
from darkroom.sources.fixtures import (
    CATALOGUE_CREATED_AT,
    PREVIOUS_RUN_CUTOFF,
    RUN_TS,
    Fixtures,
    duckdb_ctes,
    exif_records,
)

OUT = ("file_path", "date_taken", "camera_make", "camera_model", "lens", "shutter_speed", "iso", "aperture", "focal_length")
SEARCH_OUT = ("file_path", "date_taken", "camera_make", "camera_model")
DATE_FROM, DATE_TO = "2024-01-10 00:00:00", "2024-01-12 23:59:59"
RUN_LIMIT, BATCH = 120, 50


def _records(spark, sf_dir) -> DataFrame:
    return exif_records(Fixtures(spark, sf_dir).fx_exif)


def previous_catalogue(fx_exif: DataFrame) -> DataFrame:
    """Catalogue left by an earlier run that saw files up to the cutoff. It is
    input state, derived with plain column rules from the typed fixture
    columns: its camera_model came from a manual tag (the event type) and it
    kept no JSON for 'error' events, so those rows are incomplete and will be
    retried."""
    old = exif_records(
        fx_exif.where(F.col("ts") < F.lit(PREVIOUS_RUN_CUTOFF).cast("timestamp_ntz")),
        keep=("date_time_original", "create_date", "make", "iso", "iso_value"),
    )
    date_text = F.when(F.col("date_time_original") != "", F.col("date_time_original")).otherwise(F.col("create_date"))
    none = F.lit(None).cast("string")
    return old.select(
        F.col("event_id").alias("id"),
        "file_path",
        parse_exif_date(date_text).alias("date_taken"),
        clean_text(F.col("make")).alias("camera_make"),
        F.upper("event_type").alias("camera_model"),
        none.alias("lens"),
        none.alias("shutter_speed"),
        F.when(F.col("iso") != 0, F.col("iso").cast("string")).otherwise(F.col("iso_value").cast("string")).alias("iso"),
        none.alias("aperture"),
        none.alias("focal_length"),
        F.when(F.col("event_type") != "error", F.col("metadata_json")).alias("metadata_json"),
        F.lit(CATALOGUE_CREATED_AT).cast("timestamp_ntz").alias("created_at"),
    )


def stored_previous_catalogue(fx_exif: DataFrame) -> DataFrame:
    """The previous catalogue as a run finds it: a stored table. Filters on it
    (complete rows, the merge's key) then reach its Parquet scan, instead of
    being pushed through the derivation and re-evaluating the date parse."""
    return materialize(previous_catalogue(fx_exif), "previous-catalogue")


def _work(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    fx = Fixtures(spark, sf_dir)
    recs = exif_records(fx.fx_exif)
    old = stored_previous_catalogue(fx.fx_exif)
    todo = metadata.work_list(recs.select("file_path", "metadata_json"), old)
    return old, todo


def _merged(spark, sf_dir, assign_ids: bool = True) -> DataFrame:
    old, todo = _work(spark, sf_dir)
    accepted, _rejects = merge.check_keys(todo)
    return merge.merge_catalogue(old, metadata.project_for_merge(accepted), RUN_TS, assign_ids=assign_ids)


def q_exif_fields(spark, sf_dir):
    return metadata.exif_fields(_records(spark, sf_dir)).select(*OUT)


def q_exif_keys(spark, sf_dir):
    return metadata.exif_keys(_records(spark, sf_dir))


def q_exif_report(spark, sf_dir):
    return metadata.exif_report(_records(spark, sf_dir))


def q_catalogue_work_list(spark, sf_dir):
    return _work(spark, sf_dir)[1].select("file_path")


def q_merge_catalogue(spark, sf_dir):
    m = _merged(spark, sf_dir)
    return m.select("id", *OUT, F.col("metadata_json").isNotNull().alias("has_metadata_json"), "created_at")


def stored_catalogue(spark, sf_dir) -> DataFrame:
    """The merged catalogue as a run leaves it: a snapshot version partitioned
    by `taken_month`. Searches read it as users would, so a date range
    prunes month partitions and its bounds reach the Parquet scan."""
    base = f"{checkpoint_dir(spark)}/catalogue-{uuid.uuid4().hex}"
    path = write_version(metadata.with_taken_month(_merged(spark, sf_dir, False)), base, 1, partition_by=("taken_month",))
    return spark.read.parquet(path)


def q_photos_by_date(spark, sf_dir):
    return metadata.find_photos(stored_catalogue(spark, sf_dir), date_from=DATE_FROM, date_to=DATE_TO).select(*SEARCH_OUT)


def q_photos_by_camera(spark, sf_dir):
    return metadata.find_photos(stored_catalogue(spark, sf_dir), make="Canon", model="CLICK").select(*SEARCH_OUT)


def q_photos_by_json(spark, sf_dir):
    return metadata.find_photos(stored_catalogue(spark, sf_dir), json_equals={"Make": "FUJIFILM"}).select(*SEARCH_OUT)


def q_photos_by_containment(spark, sf_dir):
    """ISO as the number 200 with an empty make: the text "200" or a make that is left out would not do."""
    return metadata.find_photos(stored_catalogue(spark, sf_dir), json_holds={"ISO": 200, "Make": ""}).select(*SEARCH_OUT)


def q_catalogue_sample(spark, sf_dir):
    return metadata.sample_rows(stored_catalogue(spark, sf_dir))


def q_work_batches(spark, sf_dir):
    return metadata.with_batches(_work(spark, sf_dir)[1].select("file_path"), BATCH)


def q_work_limited(spark, sf_dir):
    return metadata.take_batchwise(_work(spark, sf_dir)[1].select("file_path"), RUN_LIMIT, BATCH)


def q_metadata_listing(spark, sf_dir):
    return metadata_listing(Fixtures(spark, sf_dir).fx_docs).select("file_path", "source_type")


# ---- DuckDB oracles ---------------------------------------------------------

_PROJ = r"""
proj AS (
  SELECT event_id, ts, event_type, file_path,
         try_strptime(CASE WHEN date_time_original <> '' THEN date_time_original ELSE create_date END,
                      '%Y:%m:%d %H:%M:%S') AS date_taken,
         nullif(trim(make), '') AS camera_make,
         CAST(NULL AS VARCHAR) AS camera_model, CAST(NULL AS VARCHAR) AS lens, CAST(NULL AS VARCHAR) AS shutter_speed,
         CASE WHEN iso <> 0 THEN CAST(iso AS VARCHAR) ELSE CAST(iso_value AS VARCHAR) END AS iso,
         CAST(NULL AS VARCHAR) AS aperture, CAST(NULL AS VARCHAR) AS focal_length,
         make AS raw_make, iso AS raw_iso
  FROM fx_exif),
old AS (
  SELECT event_id AS id, file_path, date_taken, camera_make, upper(event_type) AS camera_model, lens, shutter_speed, iso, aperture,
         focal_length, event_type <> 'error' AS has_json, raw_make, raw_iso, TIMESTAMP '""" + CATALOGUE_CREATED_AT + """' AS created_at
  FROM proj WHERE ts < TIMESTAMP '""" + PREVIOUS_RUN_CUTOFF + """'),
todo AS (
  SELECT p.* FROM proj p
  WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.file_path = p.file_path AND o.date_taken IS NOT NULL AND o.has_json)),
merged AS (
  SELECT CASE WHEN o.file_path IS NOT NULL THEN o.id
              ELSE coalesce((SELECT max(id) FROM old), 0)
                   + row_number() OVER (PARTITION BY o.file_path IS NULL ORDER BY n.file_path) END AS id,
         coalesce(o.file_path, n.file_path) AS file_path,
""" + ",\n".join(
    f"""         CASE WHEN o.file_path IS NULL THEN n.{c}
              WHEN n.file_path IS NOT NULL AND (o.date_taken IS NULL OR NOT o.has_json) THEN coalesce(n.{c}, o.{c})
              ELSE o.{c} END AS {c}"""
    for c in OUT[1:]
) + """,
         o.file_path IS NULL OR o.has_json OR n.file_path IS NOT NULL AS has_metadata_json,
         coalesce(o.raw_make, n.raw_make) AS raw_make,
         coalesce(o.raw_iso, n.raw_iso) AS raw_iso,
         CASE WHEN o.file_path IS NOT NULL THEN o.created_at ELSE TIMESTAMP '""" + RUN_TS + """' END AS created_at
  FROM old o FULL OUTER JOIN todo n ON o.file_path = n.file_path)"""

_BASE = duckdb_ctes("fx_exif") + "," + _PROJ
_COLS = ", ".join(OUT)
_SEARCH = ", ".join(SEARCH_OUT)

_KEYS = duckdb_ctes("fx_exif") + """,
kv AS (
  SELECT file_path, 'DateTimeOriginal' AS key, date_time_original AS value FROM fx_exif WHERE date_time_original IS NOT NULL
  UNION ALL SELECT file_path, 'CreateDate', create_date FROM fx_exif WHERE create_date IS NOT NULL
  UNION ALL SELECT file_path, 'Make', make FROM fx_exif WHERE make IS NOT NULL
  UNION ALL SELECT file_path, 'ISO', CAST(iso AS VARCHAR) FROM fx_exif WHERE iso IS NOT NULL
  UNION ALL SELECT file_path, 'ISOValue', CAST(iso_value AS VARCHAR) FROM fx_exif WHERE iso_value IS NOT NULL)
SELECT file_path, row_number() OVER (PARTITION BY file_path ORDER BY key) AS key_no, key, value FROM kv"""

_EXCL = "|".join(METADATA_EXCLUDE_DIRS)
_SUFFIXES = "jpg|jpeg|raw|cr2|nef|arw|dng|tif|tiff|png|raf"

ORACLE = {
    "exif_fields": _BASE + f"\nSELECT {_COLS} FROM proj",
    "exif_keys": _KEYS,
    "exif_report": duckdb_ctes("fx_exif") + """
SELECT file_path,
       coalesce(date_time_original, create_date, 'N/A') AS date_taken,
       coalesce(make, 'N/A') || ' N/A' AS camera,
       'N/A' AS lens, 'N/A' AS shutter_speed,
       coalesce(CAST(iso AS VARCHAR), CAST(iso_value AS VARCHAR), 'N/A') AS iso,
       'N/A' AS aperture, 'N/A' AS focal_length, 'N/A x N/A' AS dimensions
FROM fx_exif""",
    "catalogue_work_list": _BASE + "\nSELECT file_path FROM todo",
    "merge_catalogue": _BASE + f"\nSELECT id, {_COLS}, has_metadata_json, created_at FROM merged",
    "photos_by_date": _BASE + f"""
SELECT {_SEARCH} FROM merged
WHERE date_taken >= TIMESTAMP '{DATE_FROM}' AND date_taken <= TIMESTAMP '{DATE_TO}'""",
    "photos_by_camera": _BASE + f"\nSELECT {_SEARCH} FROM merged WHERE camera_make = 'Canon' AND camera_model = 'CLICK'",
    "photos_by_json": _BASE + f"\nSELECT {_SEARCH} FROM merged WHERE has_metadata_json AND raw_make = 'FUJIFILM'",
    "photos_by_containment": _BASE + f"\nSELECT {_SEARCH} FROM merged WHERE has_metadata_json AND raw_make = '' AND raw_iso = 200",
    "catalogue_sample": _BASE + f"\nSELECT {_SEARCH} FROM merged ORDER BY file_path LIMIT 5",
    "work_batches": _BASE + f"""
SELECT file_path, position, CAST(ceil(position / {BATCH}) AS BIGINT) AS batch_no
FROM (SELECT file_path, row_number() OVER (ORDER BY file_path) AS position FROM todo) t""",
    "work_limited": _BASE + f"""
SELECT file_path, position, CAST(ceil(position / {BATCH}) AS BIGINT) AS batch_no
FROM (SELECT file_path, row_number() OVER (ORDER BY file_path) AS position FROM todo) t
WHERE ceil(position / {BATCH}) <= {-(-RUN_LIMIT // BATCH)}""",
    "metadata_listing": duckdb_ctes("fx_docs") + f"""
SELECT file_path, source_type FROM fx_docs
WHERE regexp_matches(file_path, '\\.({_SUFFIXES}|{_SUFFIXES.upper()})$')
  AND NOT regexp_matches(file_path, '(^|/)({_EXCL})(/|$)')""",
}

QUERIES = {
    "exif_fields": q_exif_fields,
    "exif_keys": q_exif_keys,
    "exif_report": q_exif_report,
    "catalogue_work_list": q_catalogue_work_list,
    "merge_catalogue": q_merge_catalogue,
    "photos_by_date": q_photos_by_date,
    "photos_by_camera": q_photos_by_camera,
    "photos_by_json": q_photos_by_json,
    "photos_by_containment": q_photos_by_containment,
    "catalogue_sample": q_catalogue_sample,
    "work_batches": q_work_batches,
    "work_limited": q_work_limited,
    "metadata_listing": q_metadata_listing,
}
