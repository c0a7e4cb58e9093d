"""URL filters: a Bloom filter cascade over the corpus's whole key universe.

Every url has candidate keys: each suffix of its host at a label boundary with
no more labels than a listed key has, followed by each prefix of its path whose
length some listed key has; so a host of many labels makes no more keys. The
distinct candidate keys of all pages are the universe. A cascade's first level
encodes the listed keys; each later level encodes the keys that wrongly pass
the level before it, listed and unlisted in turn, until none is left. Over
that universe membership is exact, so pages are judged without a join: each
task holds the few bits of the cascades.

Three cascades: the rules' keys, the keys of the blocking rules, and listed
domains (the method's own verdict where no rule fits). A page's longest key in
the first is its rule.

Filters grow with the listed keys, not with the corpus: levels after the first
halve. Their size is checked against `max_bytes` before they are sent.

Defined results: a null url or one without `://` has empty host and path, fits
no rule and is allowed; repeated rows are judged one by one; an empty table
gives an empty result; long urls take time in their length. Only the two named
columns of `pages` are read, so no other clashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from darkroom.llm.store import stored

#: (verdict, host, path): fixed values of the contract.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Domains that are blocked, with their subdomains, where no rule fits.
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_DOMAINS = tuple(f"{name}.example.{top}" for name in LISTED_NAMES for top in ("com", "net", "org"))
MAX_BYTES = 64 << 20
#: Levels halve, so this many are reached only if hashes of different keys agree.
MAX_LEVELS = 100
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: str, path: str, path_lengths: list[int], most_labels: int) -> Column:
    """The url's keys, longest first: host suffixes times path prefixes."""
    suffix = F.substring_index(F.col(host), ".", -most_labels)  # the whole host, if it has no more labels
    labels = F.split(suffix, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = F.flatten(F.transform(suffixes, lambda s: F.array(*[F.when(F.length(path) >= n, F.concat(s, F.substring(F.col(path), 1, n))) for n in path_lengths])))
    ranked = F.sort_array(F.transform(F.array_compact(keys), lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))), asc=False)
    return F.transform(ranked, lambda s: s["k"])


@dataclass
class Level:
    number: int
    bits: int
    hashes: int
    words: np.ndarray

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.ones(len(h1), dtype=bool)
        for i in range(self.hashes):
            at = (h1 + np.uint64(i + 32 * self.number) * h2) % np.uint64(self.bits)
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


@dataclass
class Cascade:
    levels: list[Level]

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe that the cascade was built over."""
        out, still = np.zeros(len(h1), dtype=bool), np.ones(len(h1), dtype=bool)
        for i, level in enumerate(self.levels):
            passed = level.has(h1, h2)
            out[still & ~passed] = i % 2 == 1
            still &= passed
        out[still] = len(self.levels) % 2 == 1
        return out

    def nbytes(self) -> int:
        return sum(level.words.nbytes for level in self.levels)


def key_hashes(key: Column) -> tuple[Column, Column]:
    """Two non-negative hashes whose combinations h1 + i * h2 stay below 2**63."""
    return F.xxhash64(key, F.lit(11)).bitwiseAND(F.lit((1 << 48) - 1)), F.xxhash64(key, F.lit(13)).bitwiseAND(F.lit((1 << 48) - 1)).bitwiseOR(F.lit(1))


def filter_level(keys: DataFrame, n: int, rate: float, max_bytes: int, number: int) -> Level:
    """A Bloom filter of rows (h1, h2): Spark sets the bits, 64 to a row. Each
    level has hash functions of its own, else keys would collide in all."""
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2))) + 2 * number + 1
    if bits / 8 > max_bytes:
        raise ValueError(f"a filter of {bits // 8} bytes exceeds max_bytes={max_bytes}")
    at = keys.select(F.explode(F.array(*[F.pmod(F.col("h1") + (i + 32 * number) * F.col("h2"), F.lit(bits)) for i in range(hashes)])).alias("at"))
    rows = at.select(F.floor(F.col("at") / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    words = np.zeros(bits // 64 + 1, dtype=np.uint64)
    for r in rows:
        words[r["w"]] = np.uint64(r["b"] & 0xFFFFFFFFFFFFFFFF)
    return Level(number, bits, hashes, words)


def passing(keys: DataFrame, level: Level) -> DataFrame:
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            yield batch.filter(pa.array(level.has(h1, h2)))

    return keys.mapInArrow(test, keys.schema)


def build_cascade(universe: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """Cascade of the keys of `listed` (column key) that holds exactly over
    `universe` (column key, distinct) and `listed`."""
    h1, h2 = key_hashes(F.col("key"))
    inside = stored(listed.select("key").distinct().select(h1.alias("h1"), h2.alias("h2")), "cascade-in")
    outside = stored(universe.join(listed.select(F.col("key").alias("_key")).distinct(), F.col("key") == F.col("_key"), "left_anti").select(h1.alias("h1"), h2.alias("h2")), "cascade-out")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    include, exclude, n = inside, outside, n_in
    while n:
        rate = 0.5 if levels else min(0.5, max(n_in / (1.4 * max(n_out, 1)), 1e-6))
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys of the universe have equal hashes")
        levels.append(filter_level(include, n, rate, max_bytes, len(levels)))
        wrong = stored(passing(exclude, levels[-1]), "cascade-wrong")
        include, exclude, n = wrong, include, wrong.count()
    return Cascade(levels)


def judge_urls(
    pages: DataFrame, page_id: str = "page_id", url: str = "url",
    rules: tuple[tuple[str, str, str], ...] = RULES, listed_domains: tuple[str, ...] = LISTED_DOMAINS, max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict), a row per row of `pages`."""
    spark = pages.sparkSession
    lengths = sorted({0} | {len(path) for _, _, path in rules})
    most_labels = max((name.count(".") + 1 for name in [*listed_domains, *[h for _, h, _ in rules]]), default=1)
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias(page_id), host.alias("host"), path.alias("path"))
    keyed = rows.withColumn("_keys", candidate_keys("host", "path", lengths, most_labels))
    universe = stored(rows.select("host", *[F.when(F.length("path") >= n, F.substring("path", 1, n)).alias(f"p{n}") for n in lengths]).distinct()
                      .select(F.col("host"), F.coalesce(*[f"p{n}" for n in reversed(lengths)]).alias("path"))
                      .select(F.explode(candidate_keys("host", "path", lengths, most_labels)).alias("key")).distinct(), "url-universe")
    cascades = [
        build_cascade(universe, key_table(spark, [h + p for _, h, p in rules]), max_bytes),
        build_cascade(universe, key_table(spark, [h + p for v, h, p in rules if v == "block"]), max_bytes),
        build_cascade(universe, key_table(spark, list(listed_domains)), max_bytes),
    ]
    if sum(c.nbytes() for c in cascades) > max_bytes:
        raise ValueError("the cascades together exceed max_bytes")
    hashed = keyed.select(
        page_id, "host", "path", "_keys",
        F.transform("_keys", lambda k: key_hashes(k)[0]).alias("_h1"), F.transform("_keys", lambda k: key_hashes(k)[1]).alias("_h2"),
    )
    kind = dict(pages.dtypes)[page_id]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ruled, blocked, listed = cascades
        for batch in batches:
            if not len(batch):
                continue
            sizes = batch["_keys"].map(len).to_numpy()
            row = np.repeat(np.arange(len(batch)), sizes)
            h1 = np.concatenate(batch["_h1"].to_numpy()).astype(np.int64).view(np.uint64)
            h2 = np.concatenate(batch["_h2"].to_numpy()).astype(np.int64).view(np.uint64)
            keys = np.concatenate(batch["_keys"].to_numpy())
            hit = np.flatnonzero(ruled.has(h1, h2))
            rows_hit, first = np.unique(row[hit], return_index=True)
            rule = np.full(len(batch), None, dtype=object)
            rule[rows_hit] = keys[hit[first]]
            verdict = np.full(len(batch), "allow", dtype=object)
            verdict[np.unique(row[listed.has(h1, h2)])] = "block"
            at = hit[first]
            verdict[rows_hit] = np.where(blocked.has(h1[at], h2[at]), "block", "allow")
            yield batch[[page_id, "host", "path"]].assign(rule=rule, verdict=verdict)

    return hashed.mapInPandas(judge, f"`{page_id}` {kind}, host string, path string, rule string, verdict string")


def key_table(spark: SparkSession, keys: list[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key string")
