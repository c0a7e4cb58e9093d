"""Photo catalogue: EXIF projection, key listing, report lines, work list,
search, batching and sampling.

EXIF records are one JSON object per file (column `metadata_json`, text).
Each record is parsed twice per row at most: once by `from_json` into a
struct of the chain members (values as text) and once into a VARIANT for the
truthiness of chain candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.constants import (
    APERTURE_CHAIN,
    DATE_CHAIN,
    DEFAULT_BATCH_SIZE,
    ISO_CHAIN,
    LENS_CHAIN,
    REPORT_MISSING,
    SHUTTER_CHAIN,
)
from darkroom.functions.containment import contains
from darkroom.functions.exif import (
    exif_date_from_parts,
    exif_date_ok,
    exif_date_parts,
    first_present,
    json_tokens,
    strip_text,
    truthy_token,
)
from darkroom.operators.ordinal import with_ordinal

CATALOGUE_COLUMNS = (
    "file_path",
    "date_taken",
    "camera_make",
    "camera_model",
    "lens",
    "shutter_speed",
    "iso",
    "aperture",
    "focal_length",
    "metadata_json",
)

_CHAIN_KEYS = tuple(
    dict.fromkeys(DATE_CHAIN + ("Make", "Model") + LENS_CHAIN + SHUTTER_CHAIN + ISO_CHAIN + APERTURE_CHAIN + ("FocalLength",))
)


def _chain(values: dict[str, Column], truthy: dict[str, Column], keys: tuple[str, ...]) -> Column:
    """`r.get(k1) or ... or r.get(kn)` over pre-extracted values and flags."""
    *heads, last = keys
    out = values[last]
    for key in reversed(heads):
        out = F.when(truthy[key], values[key]).otherwise(out)
    return out


_CHAINS = {
    "date_text": DATE_CHAIN,
    "lens": LENS_CHAIN,
    "shutter_speed": SHUTTER_CHAIN,
    "iso": ISO_CHAIN,
    "aperture": APERTURE_CHAIN,
}
_HEADS = tuple(dict.fromkeys(k for chain in _CHAINS.values() for k in chain[:-1]))


def exif_fields(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Catalogue columns projected from EXIF records (file_path, metadata_json):
    falsy-or chains, trim-to-NULL, strict date parse of the chosen date text
    (a bad DateTimeOriginal hides a good CreateDate, as in the scripts).
    `keep` names extra input columns carried through unchanged.

    Written as stages so each shared intermediate (parsed record, member
    tokens, chosen texts, date parts) is computed once per row; Catalyst
    keeps a stage separate when its result is used more than once."""
    slots = {k: f"_k{i}" for i, k in enumerate(_CHAIN_KEYS)}
    toks = {k: f"_t{i}" for i, k in enumerate(_HEADS)}
    members = T.StructType([T.StructField(k, T.StringType()) for k in _CHAIN_KEYS])
    parsed = records.select(
        *keep,
        "file_path",
        "metadata_json",
        # Chain heads as VARIANT members, one pass over the parsed object.
        json_tokens(F.try_parse_json("metadata_json"), _HEADS).alias("_v"),
        # Typed parse of the chain members as text (source spelling, e.g. '4.0').
        F.from_json("metadata_json", members).alias("_s"),
    ).select(*keep, "file_path", "metadata_json", "_v", *[F.col("_s")[k].alias(c) for k, c in slots.items()])
    tokens = parsed.select(
        *keep, "file_path", "metadata_json", *slots.values(),
        *[F.to_json(F.col("_v")[k]).alias(t) for k, t in toks.items()],
    )
    values = {k: F.col(c) for k, c in slots.items()}
    truthy = {k: truthy_token(F.col(t)) for k, t in toks.items()}
    chosen = tokens.select(
        *keep, "file_path", "metadata_json",
        *[_chain(values, truthy, chain).alias(name) for name, chain in _CHAINS.items()],
        values["Make"].alias("camera_make"),
        values["Model"].alias("camera_model"),
        values["FocalLength"].alias("focal_length"),
    )
    staged = chosen.select(
        *keep, "file_path", "metadata_json",
        exif_date_ok("date_text").alias("_date_ok"),
        exif_date_parts("date_text").alias("_date_parts"),
        *[strip_text(F.col(c)).alias(c) for c in ("camera_make", "camera_model", "lens", "shutter_speed", "iso", "aperture", "focal_length")],
    )
    return staged.select(
        *keep,
        "file_path",
        exif_date_from_parts(F.col("_date_ok"), F.col("_date_parts")).alias("date_taken"),
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in CATALOGUE_COLUMNS[2:9]],
        "metadata_json",
    )


def project_for_merge(accepted: DataFrame) -> DataFrame:
    """`exif_fields` of records whose paths are already unique (after
    `merge.check_keys`), hash-partitioned by path first. The raw records
    (path and JSON text) are shuffled once, the projection runs after that
    exchange, and the catalogue merge joins on the same partitioning without
    another shuffle. Unique keys make the partitioning free of hot keys."""
    return exif_fields(accepted.repartition("file_path"))


def exif_keys(records: DataFrame) -> DataFrame:
    """Every key and value of each record in key order (key_no from 1).
    Row-local: sorts each record's own entries, no shuffle."""
    entries = F.array_sort(F.map_entries(F.from_json("metadata_json", "map<string,string>")))
    return records.select("file_path", F.posexplode(entries).alias("pos", "e")).select(
        "file_path",
        (F.col("pos") + 1).cast("bigint").alias("key_no"),
        F.col("e.key").alias("key"),
        F.col("e.value").alias("value"),
    )


def exif_report(records: DataFrame) -> DataFrame:
    """One-file report fields chosen by key presence (`get(a, get(b, 'N/A'))`);
    a present null prints as 'None', as Python prints it."""
    m = F.from_json("metadata_json", "map<string,string>")
    base = records.select("file_path", m.alias("_m"))

    def pick(*keys: str) -> Column:
        got = first_present(F.col("_m"), keys, "\x00missing")
        return F.when(got == "\x00missing", F.lit(REPORT_MISSING)).otherwise(F.coalesce(got, F.lit("None")))

    return base.select(
        "file_path",
        pick(*DATE_CHAIN).alias("date_taken"),
        F.concat_ws(" ", pick("Make"), pick("Model")).alias("camera"),
        pick(*LENS_CHAIN).alias("lens"),
        pick(*SHUTTER_CHAIN).alias("shutter_speed"),
        pick(*ISO_CHAIN).alias("iso"),
        pick(*APERTURE_CHAIN).alias("aperture"),
        pick("FocalLength").alias("focal_length"),
        F.concat_ws(" x ", pick("ImageWidth"), pick("ImageHeight")).alias("dimensions"),
    )


def complete_rows(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows that need no new extraction (date and JSON present)."""
    return catalogue.where(F.col("date_taken").isNotNull() & F.col("metadata_json").isNotNull())


def work_list(listing: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Listed files that still need extraction: the listing minus complete
    catalogue rows (incomplete rows are retried). Only `file_path` of the
    catalogue is read after the filter; Catalyst broadcasts it when small and
    shuffles both sides otherwise."""
    done = complete_rows(catalogue).select("file_path")
    return listing.join(done, "file_path", "left_anti")


def with_batches(df: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, order_col: str = "file_path") -> DataFrame:
    """Batch number `ceil(position / batch_size)` in path order, and `position`.
    The ordinal stores the work list (a join result) once."""
    ranked = with_ordinal(df, [order_col], name="position")
    return ranked.withColumn("batch_no", F.ceil(F.col("position") / F.lit(batch_size)).cast("bigint"))


def take_batchwise(df: DataFrame, limit: int, batch_size: int = DEFAULT_BATCH_SIZE, order_col: str = "file_path") -> DataFrame:
    """Run limit checked after each whole batch, so it rounds up to a batch
    multiple (0 = no limit). Equal to the scripts when no file fails."""
    if limit <= 0:
        return with_batches(df, batch_size, order_col)
    last_batch = -(-limit // batch_size)
    return with_batches(df, batch_size, order_col).where(F.col("batch_no") <= last_batch)


def take_exact(df: DataFrame, limit: int, order_col: str = "file_path") -> DataFrame:
    """Exact limit in path order (the alternative to the batch rounding).
    `order_col` must be unique for a repeatable cut."""
    return df.orderBy(order_col).limit(limit) if limit > 0 else df


def find_photos(
    catalogue: DataFrame,
    date_from: str | None = None,
    date_to: str | None = None,
    make: str | None = None,
    model: str | None = None,
    json_equals: dict[str, str] | None = None,
    json_holds: dict | list | None = None,
) -> DataFrame:
    """Catalogue search by date range (inclusive), camera and JSON members.
    Predicates on columns are plain comparisons, so they reach the Parquet scan
    and prune month partitions of a catalogue stored with `with_taken_month`.
    `json_equals` compares members as text; `json_holds` is containment of a
    pattern by type (`functions.containment`)."""
    cond = F.lit(True)
    month = "taken_month" in catalogue.columns
    low, high = (F.lit(d).cast("timestamp_ntz") for d in (date_from, date_to))
    if date_from is not None:
        cond = cond & (F.col("date_taken") >= low)
        if month:  # implied partition predicate, lets a stored catalogue prune months
            cond = cond & (F.col("taken_month") >= month_text(low))
    if date_to is not None:
        cond = cond & (F.col("date_taken") <= high)
        if month:
            cond = cond & (F.col("taken_month") <= month_text(high))
    if make is not None:
        cond = cond & (F.col("camera_make") == make)
    if model is not None:
        cond = cond & (F.col("camera_model") == model)
    for key, value in (json_equals or {}).items():
        cond = cond & (F.get_json_object("metadata_json", "$['" + key + "']") == value)
    if json_holds is not None:
        cond = cond & contains(F.try_parse_json("metadata_json"), json_holds)
    return catalogue.where(cond)


def month_text(d: Column) -> Column:
    """'YYYY-MM' of a timestamp, from wall-clock parts (date_format would go
    through the session time zone)."""
    return F.concat(F.lpad(F.year(d).cast("string"), 4, "0"), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0"))


def with_taken_month(catalogue: DataFrame) -> DataFrame:
    """Partition column for stored catalogues: 'YYYY-MM' of date_taken
    ('none' when undated)."""
    return catalogue.withColumn("taken_month", F.coalesce(month_text(F.col("date_taken")), F.lit("none")))


def sample_rows(catalogue: DataFrame, n: int = 5) -> DataFrame:
    """The sample query `SELECT file_path, date_taken, camera_make, camera_model
    ... LIMIT 5`, ordered by path for repeatability (distributed top-k)."""
    return catalogue.select("file_path", "date_taken", "camera_make", "camera_model").orderBy("file_path").limit(n)
