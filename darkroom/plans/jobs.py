"""End-to-end jobs: each reads the current snapshot of its tables, plans the
run with the operators, and writes the next snapshot. Side effects (copies,
uploads, object deletes, stack requests) come out as plan tables for an
executor outside Spark; nothing here talks to a network.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from darkroom import schemas
from darkroom.constants import DEFAULT_BATCH_SIZE
from darkroom.functions.checksum import with_checksum
from darkroom.operators import backup, ingest, merge, metadata, stacks
from darkroom.operators.listing import metadata_listing
from darkroom.plans.snapshots import has_tag, latest_version, next_version, read_all, read_version, version_of_tag, write_version
from darkroom.session import materialize
from darkroom.sources.frontier import list_entries, list_tree, with_attributes
from darkroom.sources.json_records import read_asset_pages, read_exif_json
from darkroom.sources.landed import landed_records


def run_catalogue(
    spark: SparkSession,
    image_root: str,
    exif_dir: str,
    catalogue_base: str,
    version: int | None,
    run_ts: str,
    limit: int = 0,
    batch_size: int = DEFAULT_BATCH_SIZE,
) -> dict[str, int]:
    """Metadata catalogue run: list images, keep those without a complete
    catalogue row, project their EXIF records, merge, write the next version.

    Landed files are opened once, for the manifest beside the catalogue; `opened`
    counts those of this run.
    Every job reads the latest version and writes the next; `version` may ask
    for a higher number, never for one that exists."""
    current = read_version(spark, catalogue_base, latest_version(spark, catalogue_base), schemas.CATALOGUE)
    listing = metadata_listing(list_tree(spark, [image_root])).select("file_path")
    todo = metadata.work_list(listing, current).select("file_path")
    if "://" in exif_dir:  # not on a mount: every run reads the landed files
        records, unreadable = read_exif_json(spark, exif_dir)
        opened = None
    else:
        records, unreadable, opened = landed_records(spark, exif_dir, catalogue_base.rstrip("/") + "_landed")
    # Stored once: the walk and the landed files are read at one moment.
    landed = materialize(metadata.exif_fields(records.join(todo, "file_path", "left_semi"), keep=("landed_at",)), "landed-records")
    incoming = merge.resolve_records(landed, "landed_at")
    if limit > 0:  # the limit counts files that have a record, not listed files
        done = metadata.take_batchwise(incoming.select("file_path"), limit, batch_size)
        incoming = incoming.join(done.select("file_path"), "file_path", "left_semi")
    # Counted while the merge is written (no second pass over the inputs).
    seen = Observation("catalogue_run")
    incoming = incoming.observe(seen, F.count(F.lit(1)).alias("processed"))
    merged = merge.merge_catalogue(current, incoming, run_ts)
    rejected = catalogue_base.rstrip("/") + "_rejects"
    version = next_version(spark, catalogue_base, rejected, at_least=version)
    write_version(metadata.with_taken_month(merged), catalogue_base, version, partition_by=("taken_month",))
    rejects = unreadable.select(F.col("landed_path").alias("file_path"), F.lit("unreadable").alias("reason"))
    write_version(rejects, rejected, version)
    return {"processed": int(seen.get.get("processed", 0))} | ({} if opened is None else {"opened": opened})


def plan_backup(
    spark: SparkSession,
    roots: Mapping[str, str],
    ledger_base: str,
    bucket: str,
    run_ts: str,
    storage_class: str | None = None,
) -> DataFrame:
    """Upload plan of one backup run; MD5 is computed for planned files only."""
    ledger = read_version(spark, ledger_base, latest_version(spark, ledger_base), schemas.LEDGER)
    inventory = backup.backup_inventory(list_tree(spark, roots))
    plan = backup.upload_plan(
        inventory, ledger, roots, bucket, _dt.datetime.fromisoformat(run_ts).isoformat(), storage_class
    )
    return with_checksum(plan)


def record_uploads(spark: SparkSession, ledger_base: str, results: DataFrame, version: int | None, run_ts: str) -> str:
    """Write the ledger version after uploads (results carry status per file;
    several for one file are resolved, in order of `seq` where they have it)."""
    ledger = read_version(spark, ledger_base, latest_version(spark, ledger_base), schemas.LEDGER)
    resolved = merge.resolve_results(results, "seq" if "seq" in results.columns else None)
    return write_version(merge.merge_ledger(ledger, resolved, run_ts), ledger_base, next_version(spark, ledger_base, at_least=version))


def plan_deletions(
    spark: SparkSession, roots: Mapping[str, str], ledger_base: str, bucket: str, run_ts: str, available: Iterable[str] | None = None,
) -> DataFrame:
    """The objects to delete: ledger rows whose file is gone. Nothing is written;
    `record_deletions` takes what the deletes came to."""
    flagged = _flagged(spark, roots, ledger_base, available)
    return backup.deletion_audit(flagged, bucket, run_ts).select("file_path", "s3_key", "s3_full_path", "source_type")


def _flagged(spark: SparkSession, roots: Mapping[str, str], ledger_base: str, available: Iterable[str] | None) -> DataFrame:
    ledger = read_version(spark, ledger_base, latest_version(spark, ledger_base), schemas.LEDGER)
    on_disk = list_tree(spark, roots)  # every file: no suffix or folder filter
    return materialize(backup.flag_deletions(ledger, on_disk, roots, available), "flagged-ledger")


def record_deletions(
    spark: SparkSession, roots: Mapping[str, str], ledger_base: str, audit_base: str, results: DataFrame,
    bucket: str, run_ts: str, run_id: str, available: Iterable[str] | None = None, version: int | None = None,
) -> DataFrame:
    """Apply reported deletes (file_path, outcome 'deleted' or 'failed'): a
    confirmed row goes to the audit and leaves the ledger, any other stays and is
    planned again. Returns planned, deleted, errors and pending per source.

    `run_id` names the report. Audit and ledger are two commits of one version
    that carry it: a repeated call, also after a stop between the two, completes
    what is missing from the stored audit rows and adds none."""
    flagged = _flagged(spark, roots, ledger_base, available)
    # Stored: the counters, the audit and the ledger are three reads of one state.
    states = materialize(backup.deletion_states(flagged, results), "deletion-states")
    version = next_version(spark, ledger_base, audit_base, at_least=version)
    if not has_tag(spark, audit_base, run_id):
        start = read_all(spark, audit_base, schemas.AUDIT).agg(F.max("id")).first()[0] or 0
        audit = backup.numbered_audit(backup.confirmed_audit(states, bucket, run_ts), start)
        write_version(merge.add_missing_columns(audit, schemas.AUDIT), audit_base, version, tag=run_id)
    if not has_tag(spark, ledger_base, run_id):
        gone = read_version(spark, audit_base, version_of_tag(spark, audit_base, run_id), schemas.AUDIT)
        ledger = read_version(spark, ledger_base, latest_version(spark, ledger_base), schemas.LEDGER)
        write_version(ledger.join(gone.select("file_path"), "file_path", "left_anti"), ledger_base, version, tag=run_id)
    return backup.deletion_outcomes(states)


def sync_deletions(
    spark: SparkSession,
    roots: Mapping[str, str],
    ledger_base: str,
    audit_dir: str,
    version: int | None,
    bucket: str,
    run_ts: str,
    available: Iterable[str] | None = None,
) -> DataFrame:
    """Both steps at once, for callers whose deletes cannot fail: plans the
    deletions, records all as done and returns the plan."""
    plan = materialize(plan_deletions(spark, roots, ledger_base, bucket, run_ts, available), "delete-plan")
    results = plan.select("file_path", F.lit(backup.DELETE_DONE).alias("outcome"))
    run_id = f"sync-{latest_version(spark, ledger_base)}"
    record_deletions(spark, roots, ledger_base, audit_dir, results, bucket, run_ts, run_id, available, version)
    return plan


def plan_card_import(
    spark: SparkSession, card_root: str, volumes: DataFrame, run_date: str, validate_dates: bool = False
) -> DataFrame:
    """Copy plan for one inserted card: pick the volume, list card and
    destination, de-duplicate by name, place by date from the name, and give a
    copy whose place is taken (a link counts) the next free `_1`, `_2`, ..."""
    route = ingest.route_volume(volumes).first()  # one row, one value
    dest_base = route["dest_base"]
    on_card = list_entries(spark, [card_root], links=False)
    card = ingest.card_files(
        with_attributes(on_card).select(F.col("path").alias("file_path")), folders=on_card.where("folder").select(F.col("path").alias("file_path")))
    destination = list_tree(spark, [dest_base], links=False).select("file_path")
    # Stored once: conflict names are looked for in the plan itself too.
    plan = materialize(ingest.copy_plan(card, destination, dest_base, run_date, validate_dates), "copy-plan")
    occupied = list_entries(spark, [dest_base]).select("path")
    return ingest.resolve_names(plan, occupied)


def plan_stacks(spark: SparkSession, pages_dir: str) -> tuple[DataFrame, DataFrame]:
    """(groups, request bodies) from landed asset pages."""
    assets = read_asset_pages(spark, pages_dir)
    return stacks.stack_groups(assets), stacks.stack_requests(assets)


def stacked_assets(assets: DataFrame) -> DataFrame:
    """The asset listing after the planned stacks are applied (members get a
    stack_count), for runs that track state themselves. Only group sizes are
    needed: a partial count per key, joined back to the candidates (AQE
    splits a hot key on the candidate side); members are not ranked."""
    cand = stacks.stack_candidates(assets)
    sizes = cand.groupBy(*stacks.KEY).agg(F.count(F.lit(1)).cast("int").alias("n")).where(F.col("n") > 1)
    marked = cand.join(sizes, list(stacks.KEY)).select("asset_id", F.col("n").alias("_n"))
    return assets.join(marked, "asset_id", "left").select(
        "asset_id", "original_file_name", "local_date_time",
        F.coalesce("_n", "stack_count").cast("int").alias("stack_count"),
    )
