"""Upserts without MERGE: full-outer joins on the natural key `file_path`,
written out as a new snapshot (see `darkroom.plans.snapshots`).

Plain Parquet has no MERGE/DELETE, so each merge reads the current snapshot
and the incoming rows, joins them once (a shuffle on `file_path`, a unique key,
so no skew), and returns the whole next snapshot. With ids, that result is
stored once and only the inserted rows are numbered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.constants import STATUS_ERROR, STATUS_UPLOADED
from darkroom.operators.metadata import CATALOGUE_COLUMNS
from darkroom.operators.ordinal import with_ordinal
from darkroom.session import materialize

CATALOGUE_VALUES = CATALOGUE_COLUMNS[1:]  # the nine columns COALESCE(new, old) may fill
LEDGER_COLUMNS = (
    "id",
    "file_path",
    "s3_key",
    "source_type",
    "file_size",
    "uploaded_at",
    "last_verified_at",
    "md5_checksum",
    "status",
)


def check_keys(df: DataFrame, key: str = "file_path") -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejects): a NULL key or a key seen more than
    once is rejected with a `reason`. Counting is a partial aggregate; the
    duplicate-key table joins back semi/anti, so a hot key is split by AQE
    instead of landing in one window task."""
    keyed = df.where(F.col(key).isNotNull())
    dup = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(key)
    accepted = keyed.join(dup, key, "left_anti")
    rejects = df.where(F.col(key).isNull()).withColumn("reason", F.lit("null_key")).unionByName(
        keyed.join(dup, key, "left_semi").withColumn("reason", F.lit("duplicate_key"))
    )
    return accepted, rejects


def resolve_records(incoming: DataFrame, order: str) -> DataFrame:
    """Several catalogue records of one path, applied in `order`, as one record.

    Applied one by one, records fill a row until it has a date: so of the
    records up to the first dated one, the last non-NULL value of each column
    stays. Both aggregations combine before the shuffle."""
    dated = incoming.where(F.col("date_taken").isNotNull()).groupBy(F.col("file_path").alias("_path")).agg(F.min(order).alias("_first"))
    used = incoming.where(F.col("file_path").isNotNull()).join(dated, F.col("file_path") == F.col("_path"), "left")
    used = used.where(F.col("_first").isNull() | (F.col(order) <= F.col("_first")))
    return used.groupBy("file_path").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in CATALOGUE_VALUES])


def resolve_results(results: DataFrame, order: str | None = None) -> DataFrame:
    """Several upload results of one path as one: the last by `order`. Without
    an order a success wins, so that no uploaded object becomes unknown."""
    values = [c for c in results.columns if c not in ("file_path", order)]
    by = [F.col(order)] if order else []
    by += [F.col("status") == STATUS_UPLOADED, F.col("s3_key"), F.col("md5_checksum"), F.col("file_size")]
    last = results.where(F.col("file_path").isNotNull()).groupBy("file_path").agg(F.max_by(F.struct(*values), F.struct(*by)).alias("_last"))
    return last.select("file_path", "_last.*")


def _prefixed(df: DataFrame, prefix: str, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def _numbered(rows: DataFrame) -> DataFrame:
    """Ids for the inserted rows of a merge result (`id` NULL on them): max
    existing id + position in path order (SERIAL-like, dense, repeatable).

    The merge result is written once to the checkpoint folder. The maximum is
    a scalar subquery over its stored `id` column, and only inserted rows go
    through the numbering windows; kept rows are read as they are. So the
    join runs once, and nothing is joined back by path."""
    stored = materialize(rows, "merge")
    start = F.coalesce(stored.agg(F.max("id")).scalar(), F.lit(0).cast("bigint"))
    fresh = with_ordinal(stored.where(F.col("id").isNull()), ["file_path"], name="_pos")
    numbered = fresh.withColumn("id", (start + F.col("_pos")).cast("bigint")).drop("_pos")
    return stored.where(F.col("id").isNotNull()).unionByName(numbered)


def number_inserts(current: DataFrame, incoming: DataFrame, buckets: int | None = None) -> DataFrame:
    """`incoming` with the column `id`: for paths that `current` lacks, the ids
    that `merge_*` would give them; NULL for the others. Passed on with
    `assign_ids=False`, the merge's result needs no storing before it is written.

    Of `current` only paths and the greatest id are read. What is stored (the
    incoming rows and the new paths) grows with the run, not with the table. On
    a table that is bucketed by path (`plans.bucketed`), pass its number of `buckets`:
    the run's rows go to these, and neither the anti-join nor the merge moves a row
    of the table. Without it Spark may shuffle the side with fewer partitions."""
    incoming = materialize(incoming, "merge-incoming")
    placed = lambda df: df.repartition(buckets, "file_path") if buckets else df
    known = current.select(F.col("file_path").alias("_known"))
    fresh = placed(incoming.select("file_path")).join(known, F.col("file_path") == F.col("_known"), "left_anti")
    start = F.coalesce(current.agg(F.max("id")).scalar(), F.lit(0).cast("bigint"))
    ids = with_ordinal(fresh, ["file_path"], name="_pos").select(F.col("file_path").alias("_path"), (start + F.col("_pos")).cast("bigint").alias("id"))
    return placed(incoming.join(ids, F.col("file_path") == F.col("_path"), "left").drop("_path"))


def _merged_id(incoming: DataFrame, assign_ids: bool) -> tuple[tuple[str, ...], Column]:
    """(the id column to take from `incoming`, if it has one to use; the id of a merged row)"""
    if assign_ids or "id" not in incoming.columns:
        return (), F.col("o_id").alias("id")
    return ("id",), F.coalesce("o_id", "n_id").alias("id")


def merge_catalogue(catalogue: DataFrame, incoming: DataFrame, run_ts: str, assign_ids: bool = True) -> DataFrame:
    """Catalogue upsert: new path -> insert (created_at = run_ts); existing
    complete row -> untouched; existing row with date or JSON NULL -> each of
    the nine value columns becomes COALESCE(new, old); id and created_at kept.
    `incoming` must have unique paths (run `check_keys` first). With
    `assign_ids=False` an `id` column of `incoming` numbers the inserted rows."""
    cols = ("id",) + CATALOGUE_COLUMNS + ("created_at",)
    own_id, merged_id = _merged_id(incoming, assign_ids)
    o = _prefixed(catalogue, "o_", cols)
    n = _prefixed(incoming, "n_", own_id + CATALOGUE_COLUMNS)
    j = o.join(n, F.col("o_file_path") == F.col("n_file_path"), "full_outer")
    has_old = F.col("o_file_path").isNotNull()
    has_new = F.col("n_file_path").isNotNull()
    incomplete = F.col("o_date_taken").isNull() | F.col("o_metadata_json").isNull()
    values = [
        F.when(~has_old, F.col("n_" + c))
        .when(has_new & incomplete, F.coalesce(F.col("n_" + c), F.col("o_" + c)))
        .otherwise(F.col("o_" + c))
        .alias(c)
        for c in CATALOGUE_VALUES
    ]
    out = j.select(
        merged_id,
        F.coalesce("o_file_path", "n_file_path").alias("file_path"),
        *values,
        F.when(has_old, F.col("o_created_at")).otherwise(F.lit(run_ts).cast("timestamp_ntz")).alias("created_at"),
    )
    return _numbered(out) if assign_ids else out


def merge_ledger(ledger: DataFrame, results: DataFrame, run_ts: str, assign_ids: bool = True) -> DataFrame:
    """Ledger upsert from upload results (file_path, s3_key, source_type,
    file_size, md5_checksum, status):
    - 'uploaded': key, size, md5, status and uploaded_at = run_ts are replaced
      (a new NULL wins); source_type of an existing row is kept;
    - 'error': a new path is inserted with status 'error' (size and md5 NULL,
      uploaded_at defaulted to run_ts); an existing row changes status only.
    Ids as in `merge_catalogue`."""
    own_id, merged_id = _merged_id(results, assign_ids)
    o = _prefixed(ledger, "o_", LEDGER_COLUMNS)
    n = _prefixed(results, "n_", own_id + ("file_path", "s3_key", "source_type", "file_size", "md5_checksum", "status"))
    j = o.join(n, F.col("o_file_path") == F.col("n_file_path"), "full_outer")
    has_old = F.col("o_file_path").isNotNull()
    has_new = F.col("n_file_path").isNotNull()
    ok = F.col("n_status") == STATUS_UPLOADED
    run = F.lit(run_ts).cast("timestamp_ntz")

    def replaced_on_success(c: str) -> Column:
        return F.when(has_new & ok, F.col("n_" + c)).when(has_new & ~has_old, F.lit(None)).otherwise(F.col("o_" + c))

    out = j.select(
        merged_id,
        F.coalesce("o_file_path", "n_file_path").alias("file_path"),
        F.when(has_new & (ok | ~has_old), F.col("n_s3_key")).otherwise(F.col("o_s3_key")).alias("s3_key"),
        F.when(has_old, F.col("o_source_type")).otherwise(F.col("n_source_type")).alias("source_type"),
        replaced_on_success("file_size").cast("bigint").alias("file_size"),
        F.when(has_new & (ok | ~has_old), run).otherwise(F.col("o_uploaded_at")).alias("uploaded_at"),
        F.col("o_last_verified_at").alias("last_verified_at"),
        replaced_on_success("md5_checksum").cast("string").alias("md5_checksum"),
        F.when(has_new, F.when(ok, F.lit(STATUS_UPLOADED)).otherwise(F.lit(STATUS_ERROR))).otherwise(F.col("o_status")).alias(
            "status"
        ),
    )
    return _numbered(out) if assign_ids else out


def error_results(failed: DataFrame) -> DataFrame:
    """Upload results for failed files (path, key, source): status 'error'."""
    return failed.select(
        "file_path",
        "s3_key",
        "source_type",
        F.lit(None).cast("bigint").alias("file_size"),
        F.lit(None).cast("string").alias("md5_checksum"),
        F.lit(STATUS_ERROR).alias("status"),
    )


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Additive schema evolution (`ADD COLUMN IF NOT EXISTS`): columns of
    `schema` absent from `df` are added as NULLs of their type."""
    out = df
    for field in schema.fields:
        if field.name not in df.columns:
            out = out.withColumn(field.name, F.lit(None).cast(field.dataType))
    return out
