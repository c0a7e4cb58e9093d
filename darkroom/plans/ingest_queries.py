"""Checked card-import queries over `documents` (fixtures fx_docs,
fx_catalogue) and their DuckDB oracles.

Every document is a file on one of three cards, one per root, imported in order
of their names; the destination library is every path the ledger knows. A card
file already in the library, or brought by an earlier card, is skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from darkroom.constants import IMAGE_EXTENSIONS, LIBRARY_UPLOAD, MIN_FREE_SPACE_GB
from darkroom.functions.names import base_name
from darkroom.operators import ingest, merge
from darkroom.session import materialize
from darkroom.sources.fixtures import RUN_DATE, Fixtures, duckdb_ctes
from darkroom.sources.json_records import libraries_to_scan
from darkroom.sources.landed import landed_states

DEST_BASE = "/srv/images"
CARD_SOURCE = "external"


def _card(fx: Fixtures) -> DataFrame:
    return ingest.card_files(fx.fx_docs.select(F.col("source_type").alias("card"), "file_path"), "card")


def _plan(fx: Fixtures) -> DataFrame:
    return ingest.copy_plan(_card(fx), fx.fx_catalogue.select("file_path"), DEST_BASE, RUN_DATE, card_col="card")


def q_copy_plan(spark, sf_dir):
    return _plan(Fixtures(spark, sf_dir))


def q_copy_summary(spark, sf_dir):
    return ingest.copy_summary(_plan(Fixtures(spark, sf_dir)))


def q_duplicate_names(spark, sf_dir):
    card = _card(Fixtures(spark, sf_dir)).withColumn("file_name", base_name("file_path"))
    _accepted, rejects = merge.check_keys(card, key="file_name")
    return rejects.select("file_path", "file_name", "reason")


def q_card_files(spark, sf_dir):
    """Three cards in one listing; the external one has two DCIM folders."""
    docs = Fixtures(spark, sf_dir).fx_docs
    rest = F.substring("file_path", 16, 1 << 30)
    dcim = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("/mnt/ext/images/DCIM"), rest)).when(
        F.col("doc_id") % 4 == 1, F.concat(F.lit("/mnt/ext/images/dcim"), rest)
    )
    path = F.coalesce(F.when(F.col("source_type") == CARD_SOURCE, dcim), F.col("file_path"))
    listing = docs.select(F.col("source_type").alias("card"), path.alias("file_path"))
    return ingest.card_files(listing, "card").select("card", "file_path")


def q_rename_plan(spark, sf_dir):
    """Every second target is taken, and of those every second `_1` too."""
    plan = materialize(_plan(Fixtures(spark, sf_dir)), "copy-plan")
    copies = plan.where("action = 'copy' AND length(file_path) % 2 = 0")
    first = F.regexp_replace("dest_path", r"\.([^.]*)$", "_1.$1")
    occupied = copies.select(F.col("dest_path").alias("path")).unionByName(
        copies.where("length(file_path) % 4 = 0").select(first.alias("path"))
    )
    return ingest.resolve_names(plan, occupied)


def q_volume_route(spark, sf_dir):
    """Volumes with the free space that the size of their files leaves."""
    docs = Fixtures(spark, sf_dir).fx_docs
    volumes = docs.groupBy(F.col("source_type").alias("volume")).agg(
        (F.sum("file_size") % 20).cast("string").alias("free_gb")
    )
    path = F.concat(F.lit("/srv/"), F.col("volume"))
    return ingest.route_volume(volumes.withColumn("path", path).withColumn("exists", F.lit(True)))


def q_library_scan(spark, sf_dir):
    """One library per source and language; the type may be NULL."""
    docs = Fixtures(spark, sf_dir).table("documents")
    libraries = docs.groupBy(F.concat_ws("/", "source", "lang").alias("id")).agg(F.min("doc_id").alias("_first"))
    kind = F.when(F.col("_first") % 3 == 0, F.lit(LIBRARY_UPLOAD)).when(F.col("_first") % 3 == 1, F.lit("EXTERNAL"))
    return libraries_to_scan(
        libraries.select("id", F.concat(F.lit("library "), "id").alias("name"), kind.alias("type")), external_only=True
    )


def q_landed_manifest(spark, sf_dir):
    """Every document has a landed record unless its file is gone; the manifest
    knows three of four, some of them with another size."""
    docs = Fixtures(spark, sf_dir).fx_docs
    at = F.timestamp_seconds(F.col("doc_id") * 60).cast("timestamp_ntz").alias("landed_time")
    path = F.concat(F.col("file_path"), F.lit(".json")).alias("landed_path")
    found = docs.where("on_disk").select(path, at, F.col("file_size").alias("landed_size"))
    size = F.when(F.col("doc_id") % 10 == 0, F.col("file_size") + 1).otherwise(F.col("file_size"))
    manifest = docs.where("doc_id % 4 <> 3").select(path, at, size.alias("landed_size"))
    return landed_states(found, manifest).select("landed_path", "landed_size", "state")


_NAME = "regexp_extract(file_path, '[^/]*$', 0)"
_EXTS = ", ".join(f"'{e}'" for e in IMAGE_EXTENSIONS)
_D = "'([0-9]{4})([0-9]{2})([0-9]{2})'"

_BASE = duckdb_ctes("fx_docs", "fx_catalogue") + f""",
card AS (
  SELECT source_type AS card, file_path, {_NAME} AS file_name FROM fx_docs
  WHERE lower(regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1)) IN ({_EXTS})),
dest AS (SELECT DISTINCT {_NAME} AS file_name FROM fx_catalogue),
firsts AS (
  SELECT file_name, card AS first_card, file_path AS first_path FROM card
  QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY card, file_path) = 1),
plan0 AS (
  SELECT c.card, c.file_path, c.file_name,
         CASE WHEN d.file_name IS NOT NULL OR c.file_path <> f.first_path THEN 'skip' ELSE 'copy' END AS action,
         CASE WHEN d.file_name IS NOT NULL OR c.card <> f.first_card THEN 'exists_at_destination'
              WHEN c.file_path <> f.first_path THEN 'duplicate_on_card' END AS reason,
         '{DEST_BASE}/' || CASE WHEN regexp_matches(c.file_name, {_D})
              THEN regexp_extract(c.file_name, {_D}, 1) || '/' || regexp_extract(c.file_name, {_D}, 2) || '/'
                   || regexp_extract(c.file_name, {_D}, 3)
              ELSE '{RUN_DATE}' END AS ddir
  FROM card c JOIN firsts f ON f.file_name = c.file_name LEFT JOIN dest d ON d.file_name = c.file_name),
plan AS (
  SELECT card, file_path, file_name, action, reason,
         CASE WHEN action = 'copy' THEN ddir END AS dest_dir,
         CASE WHEN action = 'copy' THEN ddir || '/' || file_name END AS dest_path
  FROM plan0)"""

ORACLE = {
    "copy_plan": _BASE + "\nSELECT * FROM plan",
    "copy_summary": _BASE + """
SELECT count(*) FILTER (WHERE action = 'copy') AS copied, count(*) FILTER (WHERE action = 'skip') AS skipped FROM plan""",
    "duplicate_names": _BASE + """
SELECT file_path, file_name, 'duplicate_key' AS reason FROM card
WHERE file_name IN (SELECT file_name FROM card GROUP BY file_name HAVING count(*) > 1)""",
    "card_files": duckdb_ctes("fx_docs") + f""",
listing AS (
  SELECT source_type AS card,
         CASE WHEN source_type = '{CARD_SOURCE}' AND doc_id % 4 = 0 THEN '/mnt/ext/images/DCIM' || substr(file_path, 16)
              WHEN source_type = '{CARD_SOURCE}' AND doc_id % 4 = 1 THEN '/mnt/ext/images/dcim' || substr(file_path, 16)
              ELSE file_path END AS file_path
  FROM fx_docs)
SELECT card, file_path FROM listing
WHERE (card <> '{CARD_SOURCE}' OR starts_with(file_path, '/mnt/ext/images/DCIM/'))
  AND lower(regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1)) IN ({_EXTS})""",
    "rename_plan": _BASE + """
SELECT card, file_path, file_name, action, reason, dest_dir,
       CASE WHEN action = 'copy' AND length(file_path) % 4 = 0 THEN regexp_replace(dest_path, '\\.([^.]*)$', '_2.\\1')
            WHEN action = 'copy' AND length(file_path) % 2 = 0 THEN regexp_replace(dest_path, '\\.([^.]*)$', '_1.\\1')
            ELSE dest_path END AS dest_path,
       action = 'copy' AND length(file_path) % 2 = 0 AS renamed
FROM plan""",
    "volume_route": duckdb_ctes("fx_docs") + f""",
free AS (SELECT CAST(sum(file_size) % 20 AS BIGINT) AS gb FROM fx_docs WHERE source_type = 'internal')
SELECT CASE WHEN gb < {MIN_FREE_SPACE_GB} THEN 'external' ELSE 'internal' END AS volume,
       CASE WHEN gb < {MIN_FREE_SPACE_GB} THEN '/srv/external' ELSE '/srv/internal' END AS dest_base,
       gb AS internal_free_gb
FROM free""",
    "landed_manifest": duckdb_ctes("fx_docs") + """,
both_sides AS (
  SELECT file_path || '.json' AS landed_path, on_disk AS here, doc_id % 4 <> 3 AS there, file_size AS size_here,
         CASE WHEN doc_id % 10 = 0 THEN file_size + 1 ELSE file_size END AS size_there
  FROM fx_docs)
SELECT landed_path, CASE WHEN here THEN size_here ELSE size_there END AS landed_size,
       CASE WHEN NOT here THEN 'gone' WHEN NOT there THEN 'new' WHEN size_here = size_there THEN 'known' ELSE 'changed' END AS state
FROM both_sides WHERE here OR there""",
    "library_scan": f"""
WITH libraries AS (SELECT concat_ws('/', source, lang) AS id, min(doc_id) AS f FROM documents GROUP BY 1)
SELECT id, 'library ' || id AS name, CASE WHEN f % 3 = 1 THEN 'EXTERNAL' END AS type
FROM libraries WHERE f % 3 <> 0""",
}

QUERIES = {
    "copy_plan": q_copy_plan,
    "copy_summary": q_copy_summary,
    "duplicate_names": q_duplicate_names,
    "card_files": q_card_files,
    "rename_plan": q_rename_plan,
    "volume_route": q_volume_route,
    "library_scan": q_library_scan,
    "landed_manifest": q_landed_manifest,
}
