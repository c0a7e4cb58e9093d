"""Checked backup-ledger queries over `documents` (fixtures fx_docs, fx_files,
fx_ledger) and their DuckDB oracles."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from darkroom.constants import BACKUP_EXCLUDE_DIRS, IMAGE_EXTENSIONS
from darkroom.operators import backup, merge
from darkroom.operators.roots import tag_by_root
from darkroom.plans.bucketed import read_bucketed, write_bucketed
from darkroom.session import checkpoint_dir, materialize
from darkroom.sources.fixtures import BUCKET, ROOTS, RUN_TS, Fixtures, duckdb_ctes

RUN_TS_ISO = _dt.datetime.fromisoformat(RUN_TS).isoformat()
# Upload outcome of the synthetic run: files in folders named 'es' fail.
FAILED_FOLDER = "/es/"
# Deletion outcome of the synthetic run: deletes in 'fr' fail (every second one
# is tried again and succeeds), those in 'es' are not reported yet.
DELETE_FAILS, DELETE_PENDING = "/fr/", "/es/"


def _inventory(fx: Fixtures) -> DataFrame:
    return backup.backup_inventory(fx.fx_docs)


def _plan(fx: Fixtures) -> DataFrame:
    return backup.upload_plan(_inventory(fx), fx.fx_ledger, ROOTS, BUCKET, RUN_TS_ISO)


def upload_results(plan: DataFrame) -> DataFrame:
    failed = F.col("file_path").contains(FAILED_FOLDER)
    ok = plan.where(~failed).select(
        "file_path", "s3_key", "source_type", "file_size", "md5_checksum", F.lit("uploaded").alias("status")
    )
    return ok.unionByName(merge.error_results(plan.where(failed)))


def q_inventory(spark, sf_dir):
    return _inventory(Fixtures(spark, sf_dir)).select("file_path", "source_type", "file_size", "md5_checksum")


def q_upload_plan(spark, sf_dir):
    return _plan(Fixtures(spark, sf_dir))


def q_backup_summary(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return backup.backup_summary(_inventory(fx), fx.fx_ledger)


def q_merge_ledger(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return merge.merge_ledger(fx.fx_ledger, upload_results(_plan(fx)), RUN_TS)


def q_merge_ledger_bucketed(spark, sf_dir):
    """As merge_ledger, on a ledger that is stored in buckets of its paths."""
    fx = Fixtures(spark, sf_dir)
    path = f"{checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(fx.fx_ledger, path, buckets)
    ledger = read_bucketed(spark, path, fx.fx_ledger.schema, buckets)
    results = merge.number_inserts(ledger, upload_results(_plan(fx)), buckets)
    return merge.merge_ledger(ledger, results, RUN_TS, assign_ids=False)


def nested_roots(fx: Fixtures) -> DataFrame:
    """The three roots, and a root of its own for each language folder but 'en' of the first."""
    inner = fx.fx_docs.where("lang <> 'en'").select(F.concat(F.lit("internal_"), "lang").alias("source_type"), F.concat(F.lit(ROOTS["internal"] + "/"), "lang").alias("root")).distinct()
    outer = ", ".join(f"('{tag}', '{root}')" for tag, root in ROOTS.items())
    return inner.unionByName(fx.spark.sql(f"SELECT * FROM VALUES {outer} AS t(source_type, root)"))


def q_nested_roots(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return tag_by_root(fx.fx_docs.select("doc_id", "file_path"), nested_roots(fx))


def q_upload_outcomes(spark, sf_dir):
    return backup.upload_outcomes(upload_results(_plan(Fixtures(spark, sf_dir))))


def _flagged(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return backup.flag_deletions(fx.fx_ledger, fx.fx_files, ROOTS)


def q_deletion_audit(spark, sf_dir):
    return backup.deletion_audit(_flagged(spark, sf_dir), BUCKET, RUN_TS)


def q_ledger_after_deletion(spark, sf_dir):
    return backup.ledger_after_deletion(_flagged(spark, sf_dir))


def q_deletion_summary(spark, sf_dir):
    return backup.deletion_summary(backup.deletion_audit(_flagged(spark, sf_dir), BUCKET, RUN_TS))


def deletion_results(flagged: DataFrame) -> DataFrame:
    """Reported deletes: a failure leaves a second try for even path lengths;
    one report names a path that was never planned."""
    planned = flagged.where("deleted").where(~F.col("file_path").contains(DELETE_PENDING))
    fails = F.col("file_path").contains(DELETE_FAILS)
    first = planned.select("file_path", F.when(fails, backup.DELETE_FAILED).otherwise(backup.DELETE_DONE).alias("outcome"))
    again = planned.where(fails & (F.length("file_path") % 2 == 0)).select("file_path", F.lit(backup.DELETE_DONE).alias("outcome"))
    kept = flagged.where(~F.col("deleted") & (F.col("status") == "error")).select("file_path", F.lit(backup.DELETE_DONE).alias("outcome"))
    return first.unionByName(again).unionByName(kept)


def _states(spark, sf_dir):
    # Both the states and the reports read the flagged ledger: stored once.
    flagged = materialize(_flagged(spark, sf_dir), "flagged-ledger")
    return backup.deletion_states(flagged, deletion_results(flagged))


def q_deletion_outcomes(spark, sf_dir):
    return backup.deletion_outcomes(_states(spark, sf_dir))


def q_confirmed_audit(spark, sf_dir):
    return backup.numbered_audit(backup.confirmed_audit(_states(spark, sf_dir), BUCKET, RUN_TS), start=0)


def q_ledger_after_outcomes(spark, sf_dir):
    return backup.ledger_after_outcomes(_states(spark, sf_dir))


# ---- DuckDB oracles ---------------------------------------------------------

_ROOT = "CASE source_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROOTS.items()) + " END"
_NAME = "regexp_extract(file_path, '[^/]*$', 0)"
_EXTS = ", ".join(f"'{e}'" for e in IMAGE_EXTENSIONS)
_EXCL = "|".join(BACKUP_EXCLUDE_DIRS)
_REL = f"substr(file_path, length({_ROOT}) + 2)"
_KEY = (
    f"source_type || '/' || replace(CASE WHEN starts_with(file_path, {_ROOT} || '/') AND NOT starts_with({_REL}, '..') "
    f"THEN {_REL} ELSE {_NAME} END, '\\', '/')"
)

_BASE = duckdb_ctes("fx_docs", "fx_files", "fx_ledger") + f""",
inv AS (
  SELECT file_path, source_type, file_size, md5_checksum FROM fx_docs
  WHERE lower(regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1)) IN ({_EXTS})
    AND NOT regexp_matches(file_path, '(^|/)({_EXCL})(/|$)')),
plan AS (
  SELECT file_path, source_type, {_KEY} AS s3_key, file_size, md5_checksum FROM inv i
  WHERE NOT EXISTS (SELECT 1 FROM fx_ledger l WHERE l.file_path = i.file_path AND l.status = 'uploaded')),
res AS (
  SELECT file_path, s3_key, source_type,
         CASE WHEN file_path LIKE '%{FAILED_FOLDER}%' THEN NULL ELSE file_size END AS file_size,
         CASE WHEN file_path LIKE '%{FAILED_FOLDER}%' THEN NULL ELSE md5_checksum END AS md5_checksum,
         CASE WHEN file_path LIKE '%{FAILED_FOLDER}%' THEN 'error' ELSE 'uploaded' END AS status
  FROM plan),
del AS (
  SELECT l.* FROM fx_ledger l
  WHERE l.status = 'uploaded'
    AND starts_with(l.file_path, CASE l.source_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROOTS.items())} END || '/')
    AND NOT EXISTS (SELECT 1 FROM fx_files f WHERE f.file_path = l.file_path)
    AND EXISTS (SELECT 1 FROM fx_files f2 WHERE f2.source_type = l.source_type))"""

_STATES = _BASE + f""",
states AS (
  SELECT l.*, CASE WHEN d.file_path IS NULL THEN 'kept'
                   WHEN l.file_path LIKE '%{DELETE_PENDING}%' THEN 'planned'
                   WHEN l.file_path LIKE '%{DELETE_FAILS}%' AND length(l.file_path) % 2 = 1 THEN 'failed'
                   ELSE 'confirmed' END AS state
  FROM fx_ledger l LEFT JOIN del d ON d.file_path = l.file_path)"""

_NEW_OR_INSERT = "n.file_path IS NOT NULL AND (n.status = 'uploaded' OR o.file_path IS NULL)"
# Surrogate ids: an existing row keeps its id; inserted rows get the old
# maximum + their position in path order.
_NEW_ID = (
    "CASE WHEN o.file_path IS NOT NULL THEN o.id "
    "ELSE coalesce((SELECT max(id) FROM {old}), 0) "
    "+ row_number() OVER (PARTITION BY o.file_path IS NULL ORDER BY n.file_path) END AS id"
)


def _on_success(c: str) -> str:
    return (
        f"CASE WHEN n.file_path IS NOT NULL AND n.status = 'uploaded' THEN n.{c} "
        f"WHEN n.file_path IS NOT NULL AND o.file_path IS NULL THEN NULL ELSE o.{c} END AS {c}"
    )


ORACLE = {
    "inventory": _BASE + "\nSELECT file_path, source_type, file_size, md5_checksum FROM inv",
    "upload_plan": _BASE + f"""
SELECT file_path, source_type, s3_key, 's3://{BUCKET}/' || s3_key AS s3_uri, file_size, md5_checksum,
       'source_type=' || source_type || '&upload_date={RUN_TS_ISO}&file_size=' || CAST(file_size AS VARCHAR)
       || '&original_path=' || file_path AS tagging
FROM plan""",
    "backup_summary": _BASE + """
SELECT i.source_type, count(*) AS listed,
       count(*) FILTER (WHERE l.status IS NULL OR l.status <> 'uploaded') AS to_upload,
       count(*) FILTER (WHERE l.status = 'uploaded') AS skipped,
       count(*) FILTER (WHERE l.status IS NOT NULL AND l.status <> 'uploaded') AS retries
FROM inv i LEFT JOIN fx_ledger l ON l.file_path = i.file_path
GROUP BY i.source_type""",
    "merge_ledger": _BASE + f"""
SELECT {_NEW_ID.format(old="fx_ledger")},
       coalesce(o.file_path, n.file_path) AS file_path,
       CASE WHEN {_NEW_OR_INSERT} THEN n.s3_key ELSE o.s3_key END AS s3_key,
       CASE WHEN o.file_path IS NOT NULL THEN o.source_type ELSE n.source_type END AS source_type,
       {_on_success('file_size')},
       CASE WHEN {_NEW_OR_INSERT} THEN TIMESTAMP '{RUN_TS}' ELSE o.uploaded_at END AS uploaded_at,
       o.last_verified_at,
       {_on_success('md5_checksum')},
       CASE WHEN n.file_path IS NOT NULL THEN n.status ELSE o.status END AS status
FROM fx_ledger o FULL OUTER JOIN res n ON o.file_path = n.file_path""",
    "nested_roots": duckdb_ctes("fx_docs") + f""",
roots AS (
  SELECT DISTINCT 'internal_' || lang AS source_type, '{ROOTS["internal"]}/' || lang AS root FROM fx_docs WHERE lang <> 'en'
  UNION ALL SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in ROOTS.items())}) t),
hit AS (
  SELECT d.doc_id, d.file_path, r.source_type AS root_tag, r.root,
         row_number() OVER (PARTITION BY d.doc_id ORDER BY length(r.root) DESC) AS place
  FROM fx_docs d LEFT JOIN roots r ON starts_with(d.file_path, r.root || '/'))
SELECT doc_id, file_path, root_tag, root, root_tag || '/' || substr(file_path, length(root) + 2) AS s3_key
FROM hit WHERE place = 1""",
    "upload_outcomes": _BASE + """
SELECT source_type, count(*) FILTER (WHERE status = 'uploaded') AS uploaded,
       count(*) FILTER (WHERE status <> 'uploaded') AS errors
FROM res GROUP BY source_type""",
    "deletion_audit": _BASE + f"""
SELECT file_path, s3_key, 's3://{BUCKET}/' || s3_key AS s3_full_path, source_type, file_size, uploaded_at,
       md5_checksum, status AS original_status, TIMESTAMP '{RUN_TS}' AS deleted_at
FROM del""",
    "ledger_after_deletion": _BASE + """
SELECT id, file_path, s3_key, source_type, file_size, uploaded_at, last_verified_at, md5_checksum, status
FROM fx_ledger l WHERE NOT EXISTS (SELECT 1 FROM del d WHERE d.file_path = l.file_path)""",
    "deletion_outcomes": _STATES + """
SELECT source_type, count(*) AS planned, count(*) FILTER (WHERE state = 'confirmed') AS deleted,
       count(*) FILTER (WHERE state = 'failed') AS errors, count(*) FILTER (WHERE state = 'planned') AS pending
FROM states WHERE state <> 'kept' GROUP BY source_type""",
    "confirmed_audit": _STATES + f"""
SELECT row_number() OVER (ORDER BY file_path) AS id, file_path, s3_key, 's3://{BUCKET}/' || s3_key AS s3_full_path, source_type, file_size,
       uploaded_at, md5_checksum, status AS original_status, TIMESTAMP '{RUN_TS}' AS deleted_at
FROM states WHERE state = 'confirmed'""",
    "ledger_after_outcomes": _STATES + """
SELECT id, file_path, s3_key, source_type, file_size, uploaded_at, last_verified_at, md5_checksum, status
FROM states WHERE state <> 'confirmed'""",
    "deletion_summary": _BASE + "\nSELECT source_type, count(*) AS deleted FROM del GROUP BY source_type",
}

# One result, however the ledger is stored.
ORACLE["merge_ledger_bucketed"] = ORACLE["merge_ledger"]

QUERIES = {
    "inventory": q_inventory,
    "upload_plan": q_upload_plan,
    "backup_summary": q_backup_summary,
    "merge_ledger": q_merge_ledger,
    "merge_ledger_bucketed": q_merge_ledger_bucketed,
    "nested_roots": q_nested_roots,
    "upload_outcomes": q_upload_outcomes,
    "deletion_audit": q_deletion_audit,
    "ledger_after_deletion": q_ledger_after_deletion,
    "deletion_summary": q_deletion_summary,
    "deletion_outcomes": q_deletion_outcomes,
    "confirmed_audit": q_confirmed_audit,
    "ledger_after_outcomes": q_ledger_after_outcomes,
}
