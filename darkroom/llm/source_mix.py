"""Mixing sources to target weights by a low-discrepancy slot schedule.

Each source's documents, in a fixed shuffled order, form a stream of words
that is cut into blocks of equal length. Slot n of the mix belongs to the
source in whose share of the cumulative weights the golden-ratio point
frac((n + 1) * phi) falls. Slots are ranked within their source, and the k-th
slot of a source takes its k-th block; the stream may be read twice at most.
The last block of a source is cut at its target, so each source gives its
target to the word.

Plan: one aggregation to one row per source, a window over those rows for
targets, two-level running sums for stream positions and slot ranks (no window
holds a whole source), and one join of slots to blocks on (source, block),
which is unique on the slot side.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own, last in order; repeated rows are separate documents, and
rows equal in every used column are interchangeable; an empty table or one
without words gives targets of 0.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from darkroom.llm.store import discard, stored
from darkroom.llm.words import word_count

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix is so many times as long as all documents together.
TOTAL_SHARE = 1.5
#: A source is read at most so many times.
MAX_PASSES = 2
#: Words in a block; one slot of the schedule takes one block.
BLOCK_WORDS = 2048
#: Pieces of the running sums: a source, or the schedule, is summed in so many parts.
PIECES = 1024
GOLDEN = 0.6180339887498949
RESULTS = ["size", "source_size", "target", "taken", "passes", "first_slot"]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, size).

    Sharing by weight with a ceiling per source and resharing the excess ends
    at min(ceiling, level * weight) for one level. With the sources in order
    of ceiling / weight, those before the level's place are full; the first
    place whose level does not reach its ceiling fixes the level."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("_ceiling", F.col("source_size").cast("double") * max_passes)
    whole = Window.partitionBy()
    place = F.col("_ceiling") / F.col("weight")
    earlier = Window.orderBy(place, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn(
        "_level",
        (F.sum("source_size").over(whole) * total_share - F.coalesce(F.sum("_ceiling").over(earlier), F.lit(0.0)))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))),
    )
    level = F.min(F.when(F.col("_level") <= place, F.struct(place.alias("place"), F.col("_level").alias("level")))).over(whole)["level"]
    per = per.withColumn("_fixed", level)
    target = F.coalesce(F.least(F.col("_ceiling"), F.col("_fixed") * F.col("weight")), F.col("_ceiling"))
    return per.select("source", "source_size", "weight", target.alias("target"))


def running_total(df: DataFrame, group: list[str], piece: str, order: list[Column], value: str, out: str) -> DataFrame:
    """`df` plus `out`: the sum of `value` over earlier rows of the group,
    earlier pieces first, then `order` within the piece.

    The window that sorts rows is per (group, piece); the window per group sees
    one row per piece."""
    small = df.groupBy(*group, piece).agg(F.sum(value).alias("_sum"))
    pieces = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, piece]
    small = small.select(*[F.col(c).alias(f"_same_{c}") for c in keys], F.coalesce(F.sum("_sum").over(pieces), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in keys])
    return rows.join(small, on).select(*df.columns, (F.col("_in") + F.col("_base")).cast("long").alias(out))


def golden_point(slot: Column) -> Column:
    """frac(slot * phi) as a double, precise for slots below 2**40: the slot's
    high and low 20 bits are multiplied apart."""
    high, low = F.floor(slot / (1 << 20)), F.pmod(slot, F.lit(1 << 20))
    both = F.pmod(high * F.lit((GOLDEN * (1 << 20)) % 1.0), F.lit(1.0)) + F.pmod(low * F.lit(GOLDEN), F.lit(1.0))
    return F.pmod(both, F.lit(1.0))


def schedule(targets: DataFrame, n_slots: int, block_words: int = BLOCK_WORDS, pieces: int = PIECES) -> DataFrame:
    """(slot, source, rank): which block of which source each slot takes.

    A point finds its interval of the cumulative weights by an equality join on
    a grid of `pieces` cells, each listing the few intervals that touch it.
    Slots past a source's target are dropped; the few blocks that the points
    leave over (their discrepancy) follow after the last slot."""
    spark = targets.sparkSession
    share = F.col("target") / F.sum("target").over(Window.partitionBy())
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    need = targets.where(F.col("target") >= 1).withColumn("blocks", F.ceil(F.floor("target") / block_words)).withColumn("_share", share)
    need = need.withColumn("_end", F.sum("_share").over(upto)).withColumn("_start", F.col("_end") - F.col("_share"))
    cells = need.select("source", "blocks", "_start", "_end", F.explode(F.sequence(F.floor(F.col("_start") * pieces), F.least(F.floor(F.col("_end") * pieces), F.lit(pieces - 1)))).alias("_cell"))
    slots = spark.range(1, n_slots + 1).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("_point"))
    slots = slots.withColumn("_cell", F.floor(F.col("_point") * pieces)).join(cells, "_cell").where((F.col("_point") >= F.col("_start")) & (F.col("_point") < F.col("_end")))
    slots = slots.select("slot", "source", "blocks", F.lit(1).alias("_one"), F.floor(F.col("slot") * pieces / (n_slots + 1)).alias("_piece"))
    ranked = running_total(slots, ["source"], "_piece", [F.col("slot")], "_one", "rank").where(F.col("rank") < F.col("blocks"))
    given = slots.groupBy(F.col("source").alias("_given_source")).agg(F.count(F.lit(1)).alias("given"))
    left = need.join(given, F.col("source").eqNullSafe(F.col("_given_source")), "left").select("source", "blocks", F.coalesce("given", F.lit(0)).alias("given"))
    rest = left.where(F.col("given") < F.col("blocks")).select("source", F.explode(F.sequence(F.col("given"), F.col("blocks") - 1)).alias("rank"))
    return ranked.select("slot", "source", "rank").unionByName(rest.select((F.lit(n_slots + 1) + F.col("rank")).alias("slot"), "source", "rank"))


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, max_passes: int = MAX_PASSES,
    block_words: int = BLOCK_WORDS, pieces: int = PIECES,
) -> DataFrame:
    """One row per row of `docs`: the columns `keep` (all by default), then size,
    source_size, target, taken, passes (how often the document's first word is
    taken) and first_slot (null if never taken).

    Kept columns travel in one struct; one that clashes with a result column
    gives way to it."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULTS]
    key = F.xxhash64(F.col(doc_id), F.col(text), F.lit("mix"))
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("_row"),
        F.col(source).alias("source"), word_count(F.col(text)).alias("size"), key.alias("_key"),
        F.shiftrightunsigned(key, 32).alias("_piece"), F.col(doc_id).alias("_id"),
    ).withColumn("_piece", F.pmod(F.col("_piece"), F.lit(pieces)))
    rows = stored(rows, "mix-rows")
    targets = stored(source_targets(rows, weights, total_share, max_passes), "mix-targets")
    placed = stored(running_total(rows, ["source"], "_piece", [F.col("_key"), F.col("_id"), F.col("size")], "size", "start").select("_row", "source", "size", "start"), "mix-placed")
    discard(rows)
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    n_slots = int(total / block_words * 1.02) + 64
    slots = schedule(targets, n_slots, block_words, pieces)
    streams = placed.where("size > 0").select("source", "size", "start").join(targets.select(F.col("source").alias("_source"), "source_size", F.floor("target").alias("_limit")), F.col("source").eqNullSafe(F.col("_source")))
    reads = streams.select("source", "start", "size", "_limit", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1))).alias("_pass"), "source_size")
    reads = reads.withColumn("_from", F.col("start") + F.col("_pass") * F.col("source_size")).withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("_limit"))).where("_from < _to")
    parts = reads.select(
        "source", "start", "_from", "_to", "_pass",
        F.explode(F.sequence(F.floor(F.col("_from") / block_words), F.floor((F.col("_to") - 1) / block_words))).alias("_block"),
    )
    words = F.least(F.col("_to"), (F.col("_block") + 1) * block_words) - F.greatest(F.col("_from"), F.col("_block") * block_words)
    first = F.col("_from") >= F.col("_block") * block_words
    slots = slots.select("slot", F.col("source").alias("_slot_source"), "rank")
    taken = (
        parts.join(slots, F.col("source").eqNullSafe(F.col("_slot_source")) & (F.col("_block") == F.col("rank")))
        .groupBy("source", "start")
        .agg(F.sum(words).cast("long").alias("taken"), F.sum(F.when(first, 1).otherwise(0)).cast("long").alias("passes"), F.min(F.when(first, F.col("slot"))).alias("first_slot"))
        .withColumnsRenamed({"source": "_taken_source", "start": "_taken_start"})
    )
    out = placed.join(taken, F.col("source").eqNullSafe(F.col("_taken_source")) & (F.when(F.col("size") > 0, F.col("start")) == F.col("_taken_start")), "left")
    per = targets.select(F.col("source").alias("_source"), "source_size", "target")
    out = out.join(per, F.col("source").eqNullSafe(F.col("_source")))
    return out.select(
        *[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(keep)],
        "size", F.col("source_size").cast("long"), "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("passes", F.lit(0)).cast("long").alias("passes"), "first_slot",
    )
