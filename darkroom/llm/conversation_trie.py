"""Prefix trie of conversations with subtree totals by depth-band rollup.

A node is a distinct sequence of first turns. It is named by 128 bits: every
turn's digest is tagged with its position and a prefix is the XOR of its turns'
tags, so prefixes come from a running XOR (a scan that is cut into slices, see
`prefix_keys`) and a node's parent is its own key without its last turn's tag.

Totals over subtrees (`band_totals`): depths are cut into bands of `band`
levels. Level by level, nodes first add their weights to the root of their own
band; band roots then form a tree of their own, `band` times as flat, which is
treated alike until one band holds all. On the way back, the finished totals of
band roots are added to the nodes above them (their parents, in the next band
up), and every node explodes to its ancestors inside its band only. Rounds are
log_band(depth) and a node makes at most `band` rows a level, however deep or
wide the trie is.

Defined results: turns are ordered by turn (null first), then role, then the
turn's digest, so ties and repeated rows have one order; repeated rows are turns
of their own. Null role or text is empty. Rows with a null conversation id
belong to none. An empty table has no nodes, not even the root. Other columns,
whatever their names, are not read. Texts of any length are hashed once and
never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from darkroom.llm.store import stored
from darkroom.llm.words import word_count
from darkroom.operators.ordinal import with_ordinal

#: Levels of a band: the most rows a node explodes to.
BAND = 8
#: Ids of one block of a node's sorted ids.
BLOCK_IDS = 20_000
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def key_of(k1: Column, k2: Column) -> Column:
    return F.struct(k1.alias("k1"), k2.alias("k2"))


def root_key() -> Column:
    """The key of the empty sequence."""
    return key_of(F.lit(0).cast("long"), F.lit(0).cast("long"))


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, o, d1, d2, words): each turn's place from 1 in its conversation,
    128 bits of its digest, and its number of words."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"),
        digest.alias("digest"), word_count(F.col(text)).alias("words"))
    half = lambda at: F.conv(F.substring("digest", at, 16), 16, -10).cast("long")
    rows = rows.select("conv_id", "turn", "role", half(1).alias("d1"), half(17).alias("d2"), "words")
    return with_ordinal(rows, ["turn", "role", "d1", "d2"], ["conv_id"], "o").select("conv_id", "o", "d1", "d2", "words")


def spliced(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on shared openings, from `numbered_turns`: the first
    h = crc32(id) % most turns of conversation id - id % every, then the own
    turns after the first h. Returns (conv_id, pos, d1, d2, words, ends) with a
    flag at each last turn, and (conv_id, empty) of all conversations."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select("conv_id", "size", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    of_base = sizes.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.col("size").alias("_size"))
    convs = stored(
        sizes.join(of_base, F.col("base") == F.col("_base"), "left").select(
            "conv_id", "size", "h", "base", F.least("h", F.coalesce("_size", F.lit(0))).alias("taken")), "trie-conversations")
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("o") < most)).withColumnRenamed("conv_id", "_base")
    lent = convs.join(heads, (F.col("base") == F.col("_base")) & (F.col("o") <= F.col("h"))).select(
        "conv_id", F.col("o").alias("pos"), "d1", "d2", "words", ((F.col("size") <= F.col("h")) & (F.col("o") == F.col("taken"))).alias("ends"))
    own = turns.join(convs.select(F.col("conv_id").alias("_conv"), "size", "h", "taken"), F.col("conv_id") == F.col("_conv"))
    own = own.where(F.col("o") > F.col("h")).select(
        "conv_id", (F.col("o") - F.col("h") + F.col("taken")).alias("pos"), "d1", "d2", "words", (F.col("o") == F.col("size")).alias("ends"))
    return lent.unionByName(own), convs.select("conv_id", ((F.col("size") <= F.col("h")) & (F.col("taken") == 0)).alias("empty"))


def prefix_keys(paths: DataFrame, band: int) -> DataFrame:
    """(conv_id, pos, words, ends, key, parent): the prefix that ends at each turn.

    Rows are range-partitioned by conversation and position and written with
    their slice, so that a conversation holding a third of all rows is cut too;
    the XOR of earlier slices, a row per slice and conversation, is joined in."""
    tag = paths.select("conv_id", "pos", "words", "ends", F.xxhash64("pos", "d1", "d2").alias("t1"), F.xxhash64("d2", "pos", "d1", F.lit(1)).alias("t2"))
    cut = stored(tag.repartitionByRange("conv_id", "pos").withColumn("slice", F.spark_partition_id()), "trie-turns")
    w = Window.partitionBy("slice", "conv_id").orderBy("pos")
    local = cut.withColumns({"x1": F.bit_xor("t1").over(w), "x2": F.bit_xor("t2").over(w)})
    before = Window.partitionBy("_conv").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(F.col("slice").alias("_slice"), F.col("conv_id").alias("_conv")).agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    sums = sums.select("_slice", "_conv", *[F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(b) for s, b in (("s1", "b1"), ("s2", "b2"))])
    joined = local.join(sums, (F.col("slice") == F.col("_slice")) & (F.col("conv_id") == F.col("_conv")))
    k1, k2 = F.col("x1").bitwiseXOR(F.col("b1")), F.col("x2").bitwiseXOR(F.col("b2"))
    return joined.select("conv_id", "pos", "words", "ends", key_of(k1, k2).alias("key"), key_of(k1.bitwiseXOR(F.col("t1")), k2.bitwiseXOR(F.col("t2"))).alias("parent"))


def level_nodes(keys: DataFrame, stride: int, band: int) -> DataFrame:
    """(key, parent, above): the nodes whose depth is a multiple of `stride`, the
    nearest such node above each, and its chain of such nodes inside its band,
    from the band's root to itself: at most `band` keys.

    Every group here is one conversation's turns of one band."""
    rows = keys.where(F.col("pos") % stride == 0).select("conv_id", "pos", "key", "parent")
    if stride > 1:
        up = rows.select(F.col("conv_id").alias("_conv"), (F.col("pos") + stride).alias("_pos"), F.col("key").alias("_up"))
        rows = rows.join(up, (F.col("conv_id") == F.col("_conv")) & (F.col("pos") == F.col("_pos")), "left")
        rows = rows.select("conv_id", "pos", "key", F.coalesce("_up", root_key()).alias("parent"))
    number = F.floor(F.col("pos") / (stride * band))
    w = Window.partitionBy("conv_id", number).orderBy("pos")
    chain = F.collect_list("key").over(w)
    rows = rows.select("key", "parent", F.when(number == 0, F.concat(F.array(root_key()), chain)).otherwise(chain).alias("above"))
    nodes = rows.groupBy("key").agg(F.first("parent").alias("parent"), F.first("above").alias("above"))
    root = rows.sparkSession.range(1).select(root_key().alias("key"), F.lit(None).cast(nodes.schema["parent"].dataType).alias("parent"), F.array(root_key()).alias("above"))
    return nodes.unionByName(root)


def band_totals(keys: DataFrame, weights: DataFrame, names: list[str], depth: int, band: int = BAND) -> DataFrame:
    """Sums of the columns `names` of `weights` (key, *names) over each node's subtree."""
    join = lambda left, right: left.join(right.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left").drop("_key")
    sums = [F.sum(n).alias(n) for n in names]
    levels, stride = [], 1
    while True:
        nodes = stored(join(level_nodes(keys, stride, band), weights), "trie-level")
        levels.append(nodes)
        if depth < stride * band:
            break
        weights = nodes.groupBy(F.element_at("above", 1).alias("key")).agg(*sums)
        stride *= band
    totals = None
    for nodes in reversed(levels):
        if totals is not None:
            # Finished totals of the bands' roots, summed for the nodes they hang from.
            parents = nodes.where("parent is not null").select(F.col("key").alias("_key"), "parent")
            hung = totals.join(parents, F.col("key") == F.col("_key")).groupBy(F.col("parent").alias("key")).agg(*[F.sum(n).alias("_" + n) for n in names])
            nodes = join(nodes, hung).withColumns({n: F.col(n) + F.coalesce("_" + n, F.lit(0)) for n in names})
        totals = stored(nodes.select(F.explode("above").alias("key"), *names).groupBy("key").agg(*sums), "trie-totals")
    return totals


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's conv_ids, ascending and joined by commas.

    Ids are sorted by ranges of (key, conv_id), so a key with very many is sorted
    by many tasks, and become blocks of text there; a key's blocks, in order, are
    then fed to one hash as a stream, a batch in memory at a time."""
    kind = ends.schema["key"].dataType
    block_kind = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list]]:
        """(key, values) of runs of equal keys inside each batch."""
        for batch in batches:
            k1, k2, values = (batch.column(i).to_pylist() for i in range(3))
            at = 0
            for i in range(1, len(k1) + 1):
                if i == len(k1) or k1[i] != k1[at] or k2[i] != k2[at]:
                    yield (k1[at], k2[at]), values[at:i]
                    at = i

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for (k1, k2), ids in runs(batches):
            for at in range(0, len(ids), BLOCK_IDS):
                part = ids[at:at + BLOCK_IDS]
                out.append((k1, k2, part[0], ",".join(map(str, part))))
                size += len(part)
            if size >= BLOCK_IDS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), block_kind, strict=True)], schema=block_kind)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), block_kind, strict=True)], schema=block_kind)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in done], pa.int64()), pa.array([k[1] for k, _ in done], pa.int64()), pa.array([d.hexdigest() for _, d in done], pa.string())],
                names=["k1", "k2", "ends_sha256"])

        key, digest, done = None, None, []
        for k, texts in runs(batches):
            if k != key:
                if key is not None:
                    done.append((key, digest))
                    if len(done) >= 10_000:
                        yield rows(done)
                        done = []
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(texts).encode())
        if key is not None:
            yield rows([*done, (key, digest)])

    flat = ends.select("key.k1", "key.k2", "conv_id").repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id")
    cut = flat.mapInArrow(blocks, "k1 long, k2 long, first long, ids string")
    gathered = cut.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids")
    out = gathered.mapInArrow(hashes, "k1 long, k2 long, ends_sha256 string")
    return out.select(key_of(F.col("k1"), F.col("k2")).cast(kind).alias("key"), "ends_sha256")


def conversation_trie(paths: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """The trie of `paths` (conv_id, pos from 1, d1, d2, words, ends) of the
    conversations `convs` (conv_id, empty: it has no turn), a row per node:
    key, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    keys = stored(prefix_keys(paths, band), "trie-keys")
    found = keys.groupBy("key").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("pos").cast("long").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        root_key().alias("key"), F.lit(None).cast(found.schema["parent"].dataType).alias("parent"), "conv_id",
        F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("words"))
    found = stored(found.unionByName(root), "trie-nodes")
    depth = found.agg(F.max("depth")).first()[0] or 0

    children = found.where("parent is not null").groupBy(F.col("parent").alias("_parent")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(found.join(children, F.col("key") == F.col("_parent"), "left").drop("_parent").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "own_leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
        "own_saved": (F.col("n_convs") - 1) * F.col("words")}), "trie-weighted")
    weights = nodes.select("key", F.col("own_leaf").alias("n_leaves"), F.col("own_saved").alias("saved_tokens"))
    totals = band_totals(keys, weights, ["n_leaves", "saved_tokens"], depth, band).withColumnRenamed("key", "_total")

    ends = keys.where("ends").select("key", "conv_id").unionByName(convs.where("empty").select(root_key().alias("key"), "conv_id"))
    digests = end_digests(ends).withColumnRenamed("key", "_end")
    above = nodes.select(F.col("key").alias("_up"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, F.col("key") == F.col("_total")).join(digests, F.col("key") == F.col("_end"), "left")
    out = out.join(above, F.col("parent") == F.col("_up"), "left")
    return out.select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))
