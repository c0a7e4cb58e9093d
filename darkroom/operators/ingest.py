"""Card import planning: which card files to copy where, and which to skip.

Sequential semantics of the card script, restated as set operations:
- a name already present anywhere under the destination is skipped;
- within the card the first occurrence of a name (path order) is copied and
  later ones are skipped, because by then the name exists at the destination;
- the destination folder is `YYYY/MM/DD` from the first eight digits of the
  name, else the run date.
First occurrences come from a partial `min(path)` aggregate joined back, so a
name repeated across a third of the card is never funnelled into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from darkroom.constants import MIN_FREE_SPACE_GB
from darkroom.functions.keys import date_dir
from darkroom.functions.names import base_name, is_image_any_case
from darkroom.session import materialize

DCIM_DIR = r"^(.*?/(?i:dcim))/"


def card_files(listing: DataFrame, card_col: str | None = None, folders: DataFrame | None = None) -> DataFrame:
    """Image files the import takes from a card listing (file_path[, card]):
    below the first DCIM directory (any case) when the card has one, else the
    whole card; suffix compared case-insensitively; nothing excluded.
    'First' is the smallest DCIM path (the shell takes whichever `find` lists
    first, which is unspecified). With `folders` (file_path of one card's folders,
    its root included) the DCIM directory is chosen among these: one above the
    card does not count, and one without files leaves nothing to take."""
    if folders is not None:
        chosen = folders.where(F.lower(base_name("file_path")) == "dcim").agg(F.min("file_path")).scalar()
        inside = chosen.isNull() | F.col("file_path").startswith(F.concat(chosen, F.lit("/")))
        return listing.where(inside & is_image_any_case(base_name("file_path")))
    dcim = F.regexp_extract("file_path", DCIM_DIR, 1)
    with_dcim = listing.withColumn("_dcim", F.when(dcim != "", dcim))
    if card_col:
        # One row per card (partial aggregate), equi-joined back on the card.
        chosen = with_dcim.groupBy(card_col).agg(F.min("_dcim").alias("_chosen"))
        joined = with_dcim.join(chosen, card_col, "left")
        first_dcim = F.col("_chosen")
    else:
        # One card: an uncorrelated scalar subquery, evaluated once, no join.
        joined = with_dcim
        first_dcim = with_dcim.agg(F.min("_dcim")).scalar()
    inside = first_dcim.isNull() | F.col("file_path").startswith(F.concat(first_dcim, F.lit("/")))
    return joined.where(inside & is_image_any_case(base_name("file_path"))).drop("_dcim", "_chosen")


def copy_plan(
    card: DataFrame, destination: DataFrame, dest_base: str, run_date: str, validate_dates: bool = False, card_col: str | None = None,
) -> DataFrame:
    """One row per card file: action 'copy' or 'skip', the reason of a skip,
    and the destination path of a copy.

    card: file_path; destination: file_path of every file under the
    destination (only base names are used, compared exactly). With `card_col`
    the listing holds several cards, imported in order of that column: a name
    that an earlier card brought exists at the destination.
    `validate_dates`: see `date_dir` (off by default, as in the script).

    All that a name decides (where it occurs first, whether it exists) is one
    row per name, aggregated before any join and stored. The only join with the
    files themselves then has a shuffle of its own on both sides, so AQE splits
    a name that a third of the files share."""
    cards = [card_col] if card_col else []
    files = card.select(*cards, "file_path", base_name("file_path").alias("file_name"))
    firsts = files.groupBy("file_name").agg(F.min(F.struct(*cards, "file_path")).alias("_first"))
    # The library can be far larger than a card: keep only names the card has.
    existing = (
        destination.select(base_name("file_path").alias("_name"))
        .join(firsts, F.col("_name") == F.col("file_name"), "left_semi").distinct()
    )
    names = firsts.join(existing, F.col("file_name") == F.col("_name"), "left")
    names = materialize(names.select(F.col("file_name").alias("_name"), "_first", F.col("_name").isNotNull().alias("_exists")), "card-names")
    j = files.join(names, F.col("file_name") == F.col("_name"))
    first = F.struct(*cards, "file_path") == F.col("_first")
    same_card = F.col(card_col) == F.col("_first")[card_col] if card_col else F.lit(True)
    ddir = F.concat(F.lit(dest_base.rstrip("/") + "/"), date_dir("file_name", run_date, validate_dates))
    action = F.when(F.col("_exists") | ~first, F.lit("skip")).otherwise(F.lit("copy"))
    reason = F.when(F.col("_exists") | (~first & ~same_card), F.lit("exists_at_destination")).when(~first, F.lit("duplicate_on_card"))
    return j.select(
        *cards,
        "file_path",
        "file_name",
        action.alias("action"),
        reason.alias("reason"),
        F.when(action == "copy", ddir).alias("dest_dir"),
        F.when(action == "copy", F.concat(ddir, F.lit("/"), F.col("file_name"))).alias("dest_path"),
    )


_SUFFIXED = r"^(.*)_([1-9][0-9]*)\.([^.]*)$"


def resolve_names(plan: DataFrame, occupied: DataFrame) -> DataFrame:
    """Conflict suffixes of the card script: a planned copy whose destination
    path is already taken (`occupied`: every entry at the destination, files
    as well as links and folders, column `path`) goes to `stem_k.ext` with
    the smallest k >= 1 that is free. Stem and extension split at the last
    dot as the shell does (`${f%.*}`, `${f##*.}`; a name without a dot uses
    itself for both). Destinations of the plan's other copies count as taken.

    Exact and unbounded: the candidates for k are 1 and every taken k + 1;
    the smallest candidate that is not taken is the answer (anti-join + min),
    so no list of suffixes is ever gathered."""
    copies = plan.where(F.col("action") == "copy")
    taken_paths = occupied.select(F.col("path").alias("dest_path")).unionByName(copies.select("dest_path"))
    # Copies whose target is taken by something other than themselves.
    others = occupied.select(F.col("path").alias("dest_path"))
    name = F.col("file_name")
    hit = copies.join(others, "dest_path", "left_semi").select(
        "file_path",
        F.col("dest_dir").alias("_dir"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("_stem"),
        F.when(name.contains("."), F.regexp_extract(name, r"\.([^.]*)$", 1)).otherwise(name).alias("_ext"),
    )
    keys = ["_dir", "_stem", "_ext"]
    entry = F.regexp_extract("dest_path", r"[^/]*$", 0)
    taken = taken_paths.select(
        F.regexp_extract("dest_path", r"^(.*)/[^/]*$", 1).alias("_dir"),
        F.regexp_extract(entry, _SUFFIXED, 1).alias("_stem"),
        F.regexp_extract(entry, _SUFFIXED, 3).alias("_ext"),
        F.regexp_extract(entry, _SUFFIXED, 2).try_cast("bigint").alias("_k"),
    ).where(entry.rlike(_SUFFIXED))
    wanted = hit.select(*keys).distinct()
    taken = taken.join(wanted, keys, "left_semi")
    cands = wanted.withColumn("_k", F.lit(1).cast("bigint")).unionByName(taken.withColumn("_k", F.col("_k") + 1))
    free = cands.join(taken, keys + ["_k"], "left_anti").groupBy(*keys).agg(F.min("_k").alias("_k"))
    renamed = hit.join(free, keys, "inner").select(
        "file_path",
        F.concat(F.col("_dir"), F.lit("/"), F.col("_stem"), F.lit("_"), F.col("_k").cast("string"), F.lit("."), F.col("_ext")).alias(
            "_new_path"
        ),
    )
    out = plan.join(renamed, "file_path", "left")
    return out.select(
        *[c for c in plan.columns if c != "dest_path"],
        F.coalesce("_new_path", "dest_path").alias("dest_path"),
        F.col("_new_path").isNotNull().alias("renamed"),
    )


def copy_summary(plan: DataFrame) -> DataFrame:
    """Copied and skipped counters of a plan (one row)."""
    return plan.agg(
        F.count(F.when(F.col("action") == "copy", 1)).alias("copied"),
        F.count(F.when(F.col("action") == "skip", 1)).alias("skipped"),
    )


def route_volume(volumes: DataFrame, min_free_gb: int = MIN_FREE_SPACE_GB) -> DataFrame:
    """Destination choice from the volume table (volume, path, exists, free_gb
    as text): external when the internal volume exists with less than
    `min_free_gb` free (non-numeric free space reads as 0), else internal --
    also when the internal directory is missing. One aggregate row, no join."""
    free = F.coalesce(F.when(F.col("free_gb").rlike(r"^[0-9]+$"), F.col("free_gb").try_cast("bigint")), F.lit(0))
    per = volumes.agg(
        F.max(F.when(F.col("volume") == "internal", F.col("path"))).alias("internal_path"),
        F.max(F.when(F.col("volume") == "external", F.col("path"))).alias("external_path"),
        F.max(F.when(F.col("volume") == "internal", F.col("exists"))).alias("internal_exists"),
        F.max(F.when(F.col("volume") == "internal", free)).alias("internal_free_gb"),
    )
    low = F.coalesce(F.col("internal_exists"), F.lit(False)) & (F.col("internal_free_gb") < min_free_gb)
    return per.select(
        F.when(low, F.lit("external")).otherwise(F.lit("internal")).alias("volume"),
        F.when(low, F.col("external_path")).otherwise(F.col("internal_path")).alias("dest_base"),
        F.col("internal_free_gb"),
    )
