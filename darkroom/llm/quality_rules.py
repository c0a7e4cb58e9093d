"""Quality rules: base measures of a text, then a hashed n-gram likelihood ratio.

Every document gets base measures (words, symbols, repeated lines, repeated
three-word windows) and a score: the log-likelihood ratio of its hashed
unigrams and bigrams between two multinomials, the trusted target (labelled
good documents) and the raw corpus (all documents), divided by the number of
n-grams. One threshold, derived from the labelled documents' scores, decides
all documents, so reruns agree. Every labelled document counts for the target
and for the threshold; none is sampled.

Only DataFrame functions run here. The corpus counts are one aggregation into
at most `buckets` rows; the weights come back as one literal array of exactly
that many doubles, so nothing grows with the corpus outside Spark. Labels may
grow with the documents, so they are not broadcast: one shuffle by `doc_id`
moves the texts to the labels, hashed there so that texts need no sorting. The
threshold's percentiles are exact; they come from row numbers over range
slices, so no task holds all scores.

Defined results: null and white-space-only texts have no words, score 0 and
fail the base rules; a null `doc_id` is kept and never counts as trusted;
repeated rows are judged one by one, alike. An empty table gives an empty
result. Without labels of both kinds the threshold is minus infinity, and
only the base rules reject.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from darkroom.llm.store import stored
from darkroom.llm.words import SPACES, words_of
from darkroom.operators.ordinal import with_ordinal

SYMBOLS = "#*$%&|<>"
#: Hash buckets of the two multinomials.
BUCKETS = 16384
#: Pseudo-count of a bucket in either multinomial.
SMOOTHING = 1.0
MIN_WORDS = 50
#: Share of words in repeated windows above which the base rules reject.
MAX_REPEATED_PERCENT = 50
WINDOW = 3
#: Percentiles of the good and of the bad documents' scores that the threshold lies between.
GOOD_SHARE, BAD_SHARE = 0.001, 0.95
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"]


def base_measures(docs: DataFrame, text: str) -> DataFrame:
    """`docs` plus n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    n_repeat_words counts the words inside three-word windows found twice or
    more in the text. Windows compare by 64-bit hash within one text: sorted
    with their positions, equal neighbours repeat."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    out = docs.select(
        "*",
        words_of(F.col(text)).alias("_words"),
        (F.length(value) - F.regexp_count(value, F.lit("[ \\t\\n\\x0B\\f\\r]"))).cast("long").alias("word_chars"),
        F.regexp_count(value, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    out = out.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.slice(
            F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
            F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0)),
        ).alias("_windows"),
    ).drop("_lines")
    out = out.withColumn("_ordered", F.sort_array("_windows"))
    repeats = F.exists(F.transform("_ordered", lambda h, i: F.coalesce(h == F.get("_ordered", i + 1), F.lit(False))), lambda same: same)
    out = out.withColumn("_repeats", repeats).drop("_ordered")
    out = out.withColumn("_sorted", F.when(F.col("_repeats"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = lambda e, k: (e["h"] == F.get("_sorted", k - 1)["h"]) | (e["h"] == F.get("_sorted", k + 1)["h"])
    out = out.drop("_windows", "_repeats").withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", lambda e, k: F.coalesce(again(e, k), F.lit(False))), lambda e: e["i"])))
    covered = F.aggregate(
        F.transform("_at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, n: total + n,
    )
    return out.drop("_sorted").withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_at")


def ngram_buckets(words: str, buckets: int) -> Column:
    """Buckets of the unigrams and of the bigrams of an array of words."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.slice(
        F.transform(words, lambda w, i: F.pmod(F.xxhash64(w, F.get(words, i + 1)), F.lit(buckets)).cast("int")),
        F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)),
    )
    return F.concat(one, two)


def trusted_ids(labels: DataFrame, doc_id: str, quality: str, good: bool) -> DataFrame:
    """The distinct labelled ids of one kind, all of them."""
    return (
        labels.where(F.col(doc_id).isNotNull() & (F.col(quality) == (1 if good else 0)))
        .select(F.col(doc_id).alias("_labelled")).distinct()
    )


def bucket_weights(docs: DataFrame, good: DataFrame, doc_id: str, text: str, buckets: int, smoothing: float) -> DataFrame:
    """One row: `w`, the array of log ratios of target to raw by bucket."""
    flagged = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        good.withColumn("_good", F.lit(1)).hint("shuffle_hash"), F.col("_id") == F.col("_labelled"), "left")
    counts = (
        flagged.select(F.coalesce("_good", F.lit(0)).alias("g"), words_of(F.col("_text")).alias("_words"))
        .select("g", F.explode(ngram_buckets("_words", buckets)).alias("b"))
        .groupBy("b", "g").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("b").agg(F.sum("n").cast("double").alias("raw"), F.sum(F.when(F.col("g") == 1, F.col("n")).otherwise(0)).cast("double").alias("target"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    full = every.join(counts, "b", "left").na.fill(0.0, ["raw", "target"])
    row = full.agg(F.sum("raw").alias("_raws"), F.sum("target").alias("_targets"), F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("_all"))
    share = lambda n, total: (n + F.lit(smoothing)) / (total + F.lit(smoothing * buckets))
    return row.select(F.transform("_all", lambda x: F.log(share(x["target"], F.col("_targets"))) - F.log(share(x["raw"], F.col("_raws")))).alias("w"))


def exact_percentiles(known: DataFrame) -> DataFrame:
    """A row per `_kind`: `value`, the percentile of its scores, interpolated as
    `percentile` does. Numbering the rows replaces that function, whose one
    last task would hold every different score."""
    ranked = with_ordinal(known, ["score", "_id"], ["_kind"], name="_rank")
    sizes = ranked.groupBy(F.col("_kind").alias("_of")).agg(F.max("_rank").alias("_rows"))
    place = (F.col("_rows") - 1) * F.when(F.col("_kind") == 1, F.lit(GOOD_SHARE)).otherwise(F.lit(BAD_SHARE))
    beside = ranked.join(F.broadcast(sizes), F.col("_kind") == F.col("_of")).withColumn("_place", place).where(F.abs(F.col("_rank") - 1 - F.col("_place")) < 1)
    ends = beside.groupBy("_kind").agg(F.min("score").alias("a"), F.max("score").alias("b"), F.max(F.col("_place") - F.floor("_place")).alias("part"))
    return ends.select("_kind", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((1 - F.col("part")) * F.col("a") + F.col("part") * F.col("b")).alias("value"))


def threshold_of(scored: DataFrame, good: DataFrame, bad: DataFrame) -> DataFrame:
    """One row: the score below which a document is rejected.

    Half-way between the lowest thousandth of the good documents' scores and
    the highest twentieth of the bad ones that the base rules leave, or the
    former if that is lower: clean documents come first."""
    kind = good.withColumn("_kind", F.lit(1)).unionByName(bad.withColumn("_kind", F.lit(0)))
    known = scored.where(~F.col("base_failed")).join(kind, F.col("_id") == F.col("_labelled")).select("_kind", "score", "_id")
    low = F.max(F.when(F.col("_kind") == 1, F.col("value")))
    high = F.max(F.when(F.col("_kind") == 0, F.col("value")))
    return exact_percentiles(known).agg(F.when(low.isNull() | high.isNull(), F.lit(float("-inf"))).otherwise(F.least(low, (low + high) / 2)).alias("t"))


def quality_rules(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
    keep: list[str] | None = None,
    buckets: int = BUCKETS, smoothing: float = SMOOTHING, min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per row of `docs`: the columns `keep` (all by default), then the
    base measures, `score`, `base_failed` and `kept`.

    The judged rows are stored once, so keep only what is needed beside the
    decision. A kept column that clashes with a result column gives way to it;
    other names cannot clash, as kept columns travel inside one struct."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in RESULTS]
    good = trusted_ids(labels, doc_id, quality, True)
    bad = trusted_ids(labels, doc_id, quality, False)
    weights = bucket_weights(docs, good, doc_id, text, buckets, smoothing).first()["w"]
    w = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    measured = base_measures(rows, "_text").withColumn("_grams", ngram_buckets("_words", buckets)).drop("_words", "_text")
    total = F.aggregate("_grams", F.lit(0.0), lambda s, b: s + F.get(w, b))
    scored = measured.withColumn("score", F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(F.lit(0.0))).drop("_grams")
    scored = stored(scored.withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
    ), "quality-scores")
    judged = scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold_of(scored, good, bad).scalar()))
    return judged.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(keep)], *RESULTS)
