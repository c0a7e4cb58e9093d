"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

A text's shingles are its runs of five words (all its words, if fewer). Each
tree of the forest has its own MinHash values; two texts are candidates if they
share a prefix of the matched depth in any tree. The depth is the greatest up to
`MAX_DEPTH` at which a pair at the similarity threshold shares a prefix with the
target recall. It follows from the parameters before any data are read, so the
forest is banding with one depth: no trie is stored and no prefix is shortened
while matching (see the README).

Prefixes are Spark groups keyed by (tree, prefix): every member is tied to its
group's least member, which gives families (components) without pairs. A
family's texts are compared exactly, in blocks of bounded size: a large family
becomes block pairs, so no task holds it whole. Tasks return, per text, how
many links it has and one tie that connects it to its linked texts; they never
return pairs. Components of those ties are the classes.

Equal texts are one node: copies are not compared with each other. `n_links`
counts the other texts (not copies) at or above the threshold.

Defined results: null counts as an empty text; texts without words are alike
only if equal; a null `doc_id` gets its text's class, whose id is the least
non-null one in it; repeated rows keep a row each; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.llm.bytetools import chunks, mix, prefix_hash, releasing, span_hash, word_spans
from darkroom.llm.components import connected_components
from darkroom.llm.store import discard, stored

SHINGLE_WORDS = 5
SIMILARITY = 0.8
TREES = 20
MAX_DEPTH = 12
TARGET_RECALL = 0.995
#: Texts, and bytes of shingle hashes, of a block that is compared whole.
BLOCK_TEXTS = 512
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
#: Columns of the incidence matrix that are multiplied at a time.
SLAB = 4096

_RNG = np.random.default_rng(20240301)
MULTIPLIERS = _RNG.integers(1, 2**63, size=TREES * MAX_DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def matched_depth(similarity: float = SIMILARITY, trees: int = TREES, target: float = TARGET_RECALL, start: int = MAX_DEPTH) -> int:
    """The longest prefix with which a pair at `similarity` is found with
    chance `target` or more."""
    depth = start
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < target:
        depth -= 1
    return depth


def shingles(texts: list[bytes], n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the shingle hashes of each text, in order, repeats kept."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, stops = word_spans(data)
    words = mix(span_hash(prefix_hash(data), starts, stops) + (stops - starts).astype(np.uint64))
    text_at = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(starts, text_at)
    counts = np.diff(bounds)
    total = len(words)
    run = np.zeros(total, np.uint64)
    place = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(min(n, total)):
        run[:total - k] += mix(words[k:] + place[k])
    sizes = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    out = run[np.repeat(bounds[:-1] - offsets[:-1], sizes) + np.arange(offsets[-1])]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        part = words[bounds[i]:bounds[i + 1]]
        out[offsets[i]] = mix(part + np.arange(1, len(part) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) + np.uint64(len(part))
    return mix(out), offsets


def forest_keys(hashes: np.ndarray, offsets: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """(texts, trees): the hash of each tree's prefix; texts without shingles are left 0."""
    some = np.flatnonzero(np.diff(offsets))
    keys = np.zeros((len(offsets) - 1, trees), np.uint64)
    if not len(some):
        return keys
    at = offsets[some]
    for tree in range(trees):
        key = np.full(len(some), tree + 1, np.uint64)
        for level in range(depth):
            least = np.minimum.reduceat(hashes * MULTIPLIERS[tree * MAX_DEPTH + level], at)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
        keys[some, tree] = key
    return keys


def scan(docs: DataFrame, doc_id: str, text: str, n: int, trees: int, depth: int) -> DataFrame:
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("text_key", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            rows: list[list[int] | None] = []
            for lot in chunks(texts, CHUNK_BYTES):
                hashes, offsets = shingles([texts[i] for i in lot], n)
                keys = forest_keys(hashes, offsets, trees, depth).view(np.int64)
                rows += [k if offsets[i] < offsets[i + 1] else [] for i, k in enumerate(keys.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()), pa.array(rows, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "keys"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(releasing(run), schema)


LINKS = T.StructType([T.StructField("node", T.LongType()), T.StructField("n_links", T.LongType()), T.StructField("tie", T.LongType())])


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Boolean matrix: which sets of `left` and `right` (indices) are similar enough."""
    sizes = np.array([len(s) for s in sets])
    both = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(both, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    renumber = np.cumsum(count > 1) - 1
    column = renumber[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    common = np.zeros((len(left), len(right)))
    for low in range(0, width, SLAB):
        i, j = np.searchsorted(column, (low, low + SLAB))
        matrix = np.zeros((len(sets), min(SLAB, width - low)), np.float32)
        matrix[owner[i:j], column[i:j] - low] = 1
        common += matrix[left] @ matrix[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return common >= similarity * union - 1e-9


def local_ties(nodes: np.ndarray, adjacent: np.ndarray) -> np.ndarray:
    """For each node the least node of its component in a boolean matrix."""
    label = nodes.copy()
    while True:
        near = np.where(adjacent, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, near)
        if (new == label).all():
            return label
        label = new


def compare_block(nodes: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, tie) of each row. One side: all pairs of the block; two sides:
    the pairs across."""
    n = len(nodes)
    adjacent = np.zeros((n, n), bool)
    if (sides == sides[0]).all():
        every = np.arange(n)
        adjacent = linked(sets, every, every, similarity)
        np.fill_diagonal(adjacent, False)
    else:
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        across = linked(sets, left, right, similarity)
        adjacent[np.ix_(left, right)] = across
        adjacent[np.ix_(right, left)] = across.T
    return adjacent.sum(axis=1), local_ties(nodes, adjacent)


def compare_families(rows: DataFrame, similarity: float) -> DataFrame:
    """Rows (family, low, high, side, node, shingles), one block pair per
    (family, low, high); complete groups are compared as they pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, nodes, sides, sets = None, [], [], []
        out: list[list] = [[], [], []]

        def close() -> None:
            if len(nodes) > 1 and (len(set(sides)) > 1 or open_key[1] == open_key[2]):
                own = np.array(nodes)
                links, ties = compare_block(own, np.array(sides), sets, similarity)
                hit = np.flatnonzero(links)
                for column, values in zip(out, (own, links, ties), strict=True):
                    column.extend(values[hit].tolist())

        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("family", "low", "high")], strict=True))
            for key, node, side, body in zip(keys, batch.column("node").to_pylist(), batch.column("side").to_pylist(), batch.column("shingles"), strict=True):
                if key != open_key:
                    close()
                    open_key, nodes, sides, sets = key, [], [], []
                nodes.append(node)
                sides.append(side)
                sets.append(np.frombuffer(body.as_buffer(), np.uint64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[f.name for f in LINKS])
                out = [[], [], []]
        close()
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[f.name for f in LINKS])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["family", "low", "high"]
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, "node").mapInArrow(releasing(run), LINKS)


def shingle_sets(docs: DataFrame, members: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """(node, family, shingles) of the members (node, family, doc_id, text_key)."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("text"), F.unhex(F.md5(F.coalesce(F.col(text).cast("binary"), F.lit(b"")))).alias("_key"))
    rows = rows.join(members, (F.col("_key") == F.col("text_key")) & F.col("_id").eqNullSafe(F.col("doc_id"))).select("node", "family", "text")
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("family", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            sets = []
            for lot in chunks(texts, CHUNK_BYTES):
                hashes, offsets = shingles([texts[i] for i in lot], n)
                sets += [np.unique(hashes[i:j]).tobytes() for i, j in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=["node", "family", "shingles"])

    return rows.mapInArrow(releasing(run), schema).dropDuplicates(["node"])


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
    trees: int = TREES, target_recall: float = TARGET_RECALL, block_texts: int = BLOCK_TEXTS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, text_key, class_key, class_id, n_links), a row per row of `docs`.
    The class id is the least doc_id of the class, the class key its own number."""
    depth = matched_depth(similarity, trees, target_recall)
    scanned = stored(scan(docs, doc_id, text, shingle_words, trees, depth), "near-scan")
    one = scanned.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.min("keys").alias("keys"))
    nodes = stored(one.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    entries = nodes.select("node", F.posexplode("keys").alias("tree", "prefix"))
    heads = entries.groupBy(F.col("tree").alias("_tree"), F.col("prefix").alias("_prefix")).agg(F.min("node").alias("head"), F.max("node").alias("_last")).where("head <> _last").drop("_last")
    ties = entries.join(heads, (F.col("tree") == F.col("_tree")) & (F.col("prefix") == F.col("_prefix"))).where("node <> head")
    families = connected_components(ties.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())
    members = nodes.drop("keys").join(families.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")).select("node", F.col("label").alias("family"), "doc_id", "text_key")
    sets = stored(shingle_sets(docs, members, doc_id, text, shingle_words), "near-sets")
    blocks = sets.groupBy(F.col("family").alias("_family")).agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_texts), F.ceil(F.sum(F.octet_length("shingles")) / block_bytes)).alias("blocks"))
    placed = sets.join(blocks, F.col("family") == F.col("_family")).withColumn("_block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pairs = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select(
        "family", F.least("_block", "_other").alias("low"), F.greatest("_block", "_other").alias("high"),
        F.when(F.col("_block") > F.col("_other"), 1).otherwise(0).alias("side"), "node", "shingles",
    )
    found = stored(compare_families(pairs, similarity), "near-links")
    discard(sets)
    counts = found.groupBy(F.col("node").alias("_node")).agg(F.sum("n_links").alias("n_links"))
    classes = connected_components(found.where("node <> tie").select(F.col("node").alias("a"), F.col("tie").alias("b")))
    labelled = nodes.select("node", "text_key", "doc_id").join(classes.withColumnsRenamed({"node": "_member"}), F.col("node") == F.col("_member"), "left")
    labelled = labelled.select("node", "text_key", "doc_id", F.coalesce("label", "node").alias("label"))
    ids = labelled.groupBy(F.col("label").alias("_label")).agg(F.min("doc_id").alias("class_id"))
    final = labelled.join(ids, F.col("label") == F.col("_label")).join(counts, F.col("node") == F.col("_node"), "left")
    final = final.select(F.col("text_key").alias("_key"), F.col("label").alias("class_key"), "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    out = scanned.select("doc_id", "text_key").join(final, F.col("text_key") == F.col("_key"))
    return out.select(F.col("doc_id").alias(doc_id), "text_key", "class_key", "class_id", "n_links")


def one_per_class(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options,
) -> DataFrame:
    """The rows of `docs` that stay: of each class the one with the least
    doc_id (null last), all its columns unchanged."""
    found = stored(near_duplicates(docs, doc_id, text, **options), "near-classes")
    first = F.struct(F.col(doc_id).isNull().alias("no"), F.col(doc_id).alias("id"), F.col("text_key").alias("key"))
    stay = found.groupBy("class_key").agg(F.min(first).alias("_stay")).select(F.col("_stay.id").alias("_stay_id"), F.col("_stay.key").alias("_stay_key"))
    own = F.unhex(F.md5(F.coalesce(F.col("_row")[text].cast("binary"), F.lit(b""))))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(doc_id).alias("_id")).withColumn("_key", own)
    rows = rows.join(stay, (F.col("_key") == F.col("_stay_key")) & F.col("_id").eqNullSafe(F.col("_stay_id")))
    again = Window.partitionBy("_stay_key", "_stay_id").orderBy(F.lit(0))
    return rows.withColumn("_n", F.row_number().over(again)).where("_n = 1").select("_row.*")
