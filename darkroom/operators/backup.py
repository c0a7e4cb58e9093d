"""Backup ledger: inventory, upload plan, counters, deletion sync with audit.

A listing row is (file_path, source_type[, file_size, md5_checksum]); the
root of each source tag comes from a small configuration mapping, turned into
a CASE expression (no join). Effects (uploads, deletes) come out as plan
tables; nothing here talks to a network.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from darkroom.constants import BACKUP_EXCLUDE_DIRS, STATUS_UPLOADED
from darkroom.functions.keys import full_uri, object_tags, root_of, storage_key, tag_text, under_root
from darkroom.operators.listing import backup_listing
from darkroom.operators.ordinal import with_ordinal

#: Outcomes that a results table reports for a planned delete.
DELETE_DONE, DELETE_FAILED = "deleted", "failed"


def tag_listing(listings: Mapping[str, DataFrame]) -> DataFrame:
    """Union of per-root listings, each tagged with its source type."""
    out = None
    for source_type, df in listings.items():
        tagged = df.withColumn("source_type", F.lit(source_type))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no listing given")
    return out


def backup_inventory(listing: DataFrame, excluded: tuple[str, ...] = BACKUP_EXCLUDE_DIRS) -> DataFrame:
    """Files the backup considers: image suffix in any case, no excluded
    directory component ('library' is kept)."""
    return backup_listing(listing, excluded)


def uploaded_paths(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == STATUS_UPLOADED).select("file_path")


def upload_plan(
    inventory: DataFrame,
    ledger: DataFrame,
    roots: Mapping[str, str],
    bucket: str,
    run_ts_iso: str,
    storage_class: str | None = None,
) -> DataFrame:
    """Inventory minus paths already uploaded (error rows are retried), with
    storage key, full URI and the tag text sent with the object.
    `storage_class` (e.g. 'DEEP_ARCHIVE') adds a column naming the class to
    request; the scripts send none, so by default there is no such column."""
    todo = inventory.join(uploaded_paths(ledger), "file_path", "left_anti")
    key = storage_key("file_path", "source_type", root_of("source_type", roots))
    planned = todo.select("file_path", "source_type", "file_size", "md5_checksum", key.alias("s3_key"))
    out = planned.select(
        "file_path",
        "source_type",
        "s3_key",
        full_uri(bucket, "s3_key").alias("s3_uri"),
        "file_size",
        "md5_checksum",
        tag_text(object_tags("source_type", run_ts_iso, "file_size", "file_path")).alias("tagging"),
    )
    return out if storage_class is None else out.withColumn("storage_class", F.lit(storage_class))


def backup_summary(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per source: files listed, to upload, skipped (already uploaded), and
    retries (ledger says 'error'). One left join and one aggregation."""
    state = ledger.select("file_path", F.col("status").alias("_ledger_status"))
    j = inventory.select("file_path", "source_type").join(state, "file_path", "left")
    uploaded = F.col("_ledger_status") == STATUS_UPLOADED
    return j.groupBy("source_type").agg(
        F.count(F.lit(1)).alias("listed"),
        F.count(F.when(~F.coalesce(uploaded, F.lit(False)), 1)).alias("to_upload"),
        F.count(F.when(uploaded, 1)).alias("skipped"),
        F.count(F.when(F.col("_ledger_status").isNotNull() & ~uploaded, 1)).alias("retries"),
    )


def upload_outcomes(results: DataFrame) -> DataFrame:
    """Per source: files uploaded and upload errors of a run's results."""
    return results.groupBy("source_type").agg(
        F.count(F.when(F.col("status") == STATUS_UPLOADED, 1)).alias("uploaded"),
        F.count(F.when(F.col("status") != STATUS_UPLOADED, 1)).alias("errors"),
    )


def flag_deletions(
    ledger: DataFrame,
    on_disk: DataFrame,
    roots: Mapping[str, str],
    available: Iterable[str] | None = None,
    refuse_empty_roots: bool = True,
) -> DataFrame:
    """The whole ledger with a `deleted` flag: an 'uploaded' row below its
    source's root (`root + '/'` prefix, no LIKE wildcards) whose path is no
    longer on disk, for an available root. `on_disk` is the unfiltered listing
    (every file, any suffix, excluded folders included).

    With `refuse_empty_roots`, a root whose listing is empty counts as
    unavailable: an unmounted drive must not read as "everything deleted"."""
    avail = list(roots) if available is None else [s for s in available if s in roots]
    present = on_disk.select("file_path").distinct().withColumn("_on_disk", F.lit(True))
    flagged = ledger.join(present, "file_path", "left")
    root = root_of("source_type", roots)
    candidate = (
        (F.col("status") == STATUS_UPLOADED)
        & F.col("source_type").isin(*avail)
        & F.coalesce(under_root("file_path", root), F.lit(False))
    )
    if refuse_empty_roots:
        # At most one row per configured root: a proven bound, so broadcast.
        listed = (
            on_disk.where(F.col("source_type").isin(*avail)).select("source_type").distinct()
            .withColumn("_root_listed", F.lit(True))
        )
        flagged = flagged.join(F.broadcast(listed), "source_type", "left")
        candidate = candidate & F.coalesce(F.col("_root_listed"), F.lit(False))
    gone = candidate & F.col("_on_disk").isNull()
    return flagged.withColumn("deleted", gone).drop("_on_disk", "_root_listed")


def deletion_audit(flagged: DataFrame, bucket: str, run_ts: str) -> DataFrame:
    """Audit rows for flagged deletions: full URI, original status, deleted_at."""
    return flagged.where("deleted").select(
        "file_path",
        "s3_key",
        full_uri(bucket, "s3_key").alias("s3_full_path"),
        "source_type",
        "file_size",
        "uploaded_at",
        "md5_checksum",
        F.col("status").alias("original_status"),
        F.lit(run_ts).cast("timestamp_ntz").alias("deleted_at"),
    )


def ledger_after_deletion(flagged: DataFrame) -> DataFrame:
    """The ledger without the flagged rows."""
    return flagged.where(~F.col("deleted")).drop("deleted")


def deletion_states(flagged: DataFrame, results: DataFrame) -> DataFrame:
    """The flagged ledger with the `state` of every row after the reported
    deletes `results` (file_path, outcome):

        kept       not flagged: the file is there, or the row is no candidate
        planned    flagged, nothing reported: the delete has yet to run
        failed     flagged, only failures reported: it is planned again
        confirmed  flagged, a success reported (before or after failures)

    A deleted object stays deleted, so the order of reports does not matter and
    reports of one path, however many, become one row by a partial aggregate
    before the join. A report on a path that is not flagged changes nothing."""
    done = results.groupBy(F.col("file_path").alias("_path")).agg(F.max(F.when(F.col("outcome") == DELETE_DONE, 1).otherwise(0)).alias("_done"))
    state = (
        F.when(~F.col("deleted"), F.lit("kept"))
        .when(F.col("_done") == 1, F.lit("confirmed"))
        .when(F.col("_done") == 0, F.lit("failed"))
        .otherwise(F.lit("planned"))
    )
    joined = flagged.join(done, F.col("file_path") == F.col("_path"), "left")
    return joined.withColumn("state", state).drop("_path", "_done", "deleted")


def deletion_outcomes(states: DataFrame) -> DataFrame:
    """Per source: deletes planned, done, failed and not reported yet."""
    count = lambda s: F.count(F.when(F.col("state") == s, 1))
    return states.where(F.col("state") != "kept").groupBy("source_type").agg(
        F.count(F.lit(1)).alias("planned"), count("confirmed").alias("deleted"), count("failed").alias("errors"), count("planned").alias("pending"),
    )


def confirmed_audit(states: DataFrame, bucket: str, run_ts: str) -> DataFrame:
    """Audit rows of the confirmed deletes only."""
    return deletion_audit(states.withColumn("deleted", F.col("state") == "confirmed"), bucket, run_ts)


def numbered_audit(audit: DataFrame, start: int) -> DataFrame:
    """Audit rows with their surrogate `id`: `start` + position in path order."""
    numbered = with_ordinal(audit, ["file_path"], name="_pos")
    return numbered.select((F.lit(start) + F.col("_pos")).cast("bigint").alias("id"), *audit.columns)


def ledger_after_outcomes(states: DataFrame) -> DataFrame:
    """The ledger without the confirmed rows: failed and unreported deletes stay
    and are flagged again by the next run."""
    return states.where(F.col("state") != "confirmed").drop("state")


def deletion_summary(audit: DataFrame) -> DataFrame:
    """Deleted objects per source."""
    return audit.groupBy("source_type").agg(F.count(F.lit(1)).alias("deleted"))
