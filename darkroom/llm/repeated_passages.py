"""Suffix-array de-duplication: bytes inside long strings that occur twice.

A byte goes if a string of `length` bytes that covers it also starts anywhere
else. Sorting all suffixes of a corpus would move every byte many times over,
so only suffixes at anchors are ordered: the minimisers of each `length`-byte
window (the least-hashed `GRAM`-byte string in it, leftmost on ties). Equal
windows have equal anchors at equal offsets, so no repeat is missed.

1. `anchors`: one scan hashes every text and yields (gram, context, place) per
   anchor; the context is all that any window around the anchor can reach.
2. Grams at a single place cannot repeat; one aggregation finds the others.
3. Anchors whose whole context occurs at two places are repeated throughout.
   This settles the inside of shared passages and of copies, by counting.
4. The other contexts of a gram, one representative each, go to one task,
   where `suffix_order` orders the texts right and left of the anchors by
   deep-shallow sorting; common prefixes of neighbours give the windows that
   repeat, byte for byte. A gram with more than `group_rows` contexts (the edge
   of a very common passage) is counted instead: by Spark, over its windows'
   hashes, first in blocks of offsets, then each offset of blocks that repeat.
5. Spans return to their texts and are merged.

Texts are known by their MD5; a text that several rows hold goes as a whole if
it has a window at all. Nothing is collected to the driver.

Defined results: a null text is empty, has no window and keeps its row; texts
below `length` bytes keep all; repeated rows lose all alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.llm.bytetools import chunks, column_bytes, mix, prefix_hash, releasing, sliding_min, span_hash
from darkroom.llm.store import discard, stored
from darkroom.llm.suffix_order import window_matches

LENGTH = 200
GRAM = 64
#: Contexts of one gram that one task orders; more are counted by Spark.
GROUP_ROWS = 20_000
#: Bytes hashed at a time; longer texts are hashed in overlapping slices.
CHUNK_BYTES = 1 << 20
#: Contexts whose windows are matched at a time.
MATCH_ROWS = 20_000
OFFSET_BLOCK = 8

ANCHOR = T.StructType([
    T.StructField("text_key", T.BinaryType()), T.StructField("pos", T.LongType()),
    T.StructField("gram", T.LongType()), T.StructField("context", T.LongType()), T.StructField("place", T.LongType()),
])


def find_anchors(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Places of the minimisers of every window inside one text; `begin` and
    `end` bound each byte's text."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64)
    prefix = prefix_hash(data)
    starts = np.arange(n - gram + 1)
    bits = np.uint64(max(1, int(n).bit_length()))
    key = (mix(span_hash(prefix, starts, starts + gram)) >> bits << bits) | starts.astype(np.uint64)
    least = sliding_min(key, length - gram + 1)
    inside = np.flatnonzero(np.arange(len(least)) + length <= end[:len(least)])
    return np.unique((least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))


def anchors_of(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text number, pos, gram hash, context hash) of the anchors of some texts."""
    reach = length - gram
    found = []
    for lot in chunks(texts, CHUNK_BYTES):
        for piece, first, shift, own in slices([texts[i] for i in lot], lot.start, length):
            data, offsets = column_bytes(pa.array(piece, pa.large_binary()))
            sizes = np.diff(offsets)
            begin, end = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
            at = find_anchors(data, begin, end, length, gram)
            if own is not None:
                at = at[(at + shift >= own[0]) & (at + shift < own[1])]
            if not len(at):
                continue
            prefix = prefix_hash(data)
            left, right = np.maximum(at - reach, begin[at]), np.minimum(at + length, end[at])
            shape = (at - left).astype(np.uint64) * np.uint64(4099) + (right - at).astype(np.uint64)
            context = mix(span_hash(prefix, left, right) + shape * np.uint64(0x9E3779B97F4A7C15))
            text = np.searchsorted(offsets, at, side="right") - 1
            found.append((text + first, at - offsets[text] + shift, mix(span_hash(prefix, at, at + gram)), context))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def slices(texts: list[bytes], first: int, length: int) -> Iterator[tuple[list[bytes], int, int, tuple[int, int] | None]]:
    """The texts themselves, or overlapping slices of a single very long one,
    each with the places that it owns.

    A slice overlaps its neighbours by 2 * length on both sides, so every window
    with an owned place and every context of one lies in it as in the whole
    text; of a place that several slices find, only its owner yields the anchor."""
    if len(texts) > 1 or len(texts[0]) <= 8 * CHUNK_BYTES:
        yield texts, first, 0, None
        return
    text, margin = texts[0], 2 * length
    for at in range(0, len(text), 4 * CHUNK_BYTES):
        low = max(0, at - margin)
        yield [text[low:at + 4 * CHUNK_BYTES + margin]], first, low, (at, at + 4 * CHUNK_BYTES)


def anchors(docs: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).to_pylist()]
            keys = np.array([hashlib.md5(t).digest() for t in texts], dtype="V16")
            number, pos, grams, contexts = anchors_of(texts, length, gram)
            own = keys.view("<u8").reshape(-1, 2)[number] if len(number) else np.zeros((0, 2), np.uint64)
            place = mix(own[:, 0] ^ mix(own[:, 1] + pos.astype(np.uint64)))
            key = pa.array(keys[number].tolist(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(pos), *[pa.array(x.view(np.int64)) for x in (grams, contexts, place)]], names=[f.name for f in ANCHOR])

    return docs.select(F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text")).where(F.octet_length("text") >= length).mapInArrow(releasing(scan), ANCHOR)


def text_key(text: str) -> F.Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("binary"), F.lit(b""))))


CONTEXT = T.StructType([
    T.StructField("gram", T.LongType()), T.StructField("context", T.LongType()),
    T.StructField("before", T.IntegerType()), T.StructField("bytes", T.BinaryType()),
])


def cut_contexts(docs: DataFrame, wanted: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    """The bytes around the wanted anchors (text_key, pos, gram, context)."""
    per_text = wanted.groupBy(F.col("text_key").alias("_key")).agg(F.collect_list(F.struct("pos", "gram", "context")).alias("_at"))
    rows = docs.select(text_key(text).alias("text_key"), F.col(text).cast("binary").alias("text"))
    rows = rows.join(per_text, F.col("text_key") == F.col("_key")).select("text", "_at")
    reach = length - gram

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            lists = batch.column("_at")
            flat, bounds = lists.flatten(), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            pos, grams, contexts = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for i, value in enumerate(batch.column("text").to_pylist()):
                for j in range(bounds[i], bounds[i + 1]):
                    p = int(pos[j])
                    low = max(0, p - reach)
                    out[0].append(grams[j])
                    out[1].append(contexts[j])
                    out[2].append(p - low)
                    out[3].append(value[low:p + length])
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=[f.name for f in CONTEXT])

    # copies of one text give the same contexts
    return rows.mapInArrow(releasing(cut), CONTEXT).dropDuplicates(["gram", "context"])


MATCH = T.StructType([
    T.StructField("gram", T.LongType()), T.StructField("context", T.LongType()),
    T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType()),
])


def match_contexts(grams: np.ndarray, before: np.ndarray, parts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """`window_matches` for contexts given as bytes."""
    reach = length - gram
    n = len(parts)
    sizes = np.fromiter(map(len, parts), np.int64, n)
    whole = np.zeros((n, reach + length), np.uint8)
    flat = np.frombuffer(b"".join(parts), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255; 0 is left for padding
    row = np.repeat(np.arange(n), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(reach - before, sizes)
    whole[row, column] = flat
    _, group = np.unique(grams, return_inverse=True)
    return window_matches(np.ascontiguousarray(whole[:, :reach][:, ::-1]), np.ascontiguousarray(whole[:, reach:]), before, sizes - before, group, length)


def match_in_tasks(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            low, high = match_contexts(
                table.column("gram").to_numpy(), table.column("before").to_numpy().astype(np.int64), table.column("bytes").to_pylist(), length, gram)
            hit = np.flatnonzero(low >= 0)
            return pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks().take(pa.array(hit)) for c in ("gram", "context")]
                + [pa.array(x[hit].astype(np.int32)) for x in (low, high)], names=[f.name for f in MATCH])

        for batch in batches:  # sorted by gram: a gram's rows may go on in the next batch
            kept.append(batch)
            if sum(b.num_rows for b in kept) < MATCH_ROWS:
                continue
            table = pa.Table.from_batches(kept)
            of = table.column("gram").to_numpy()
            cut = int(np.searchsorted(of, of[-1]))
            if cut:
                yield done(table.slice(0, cut))
                kept = table.slice(cut).to_batches()
        if kept and sum(b.num_rows for b in kept):
            yield done(pa.Table.from_batches(kept))

    parts = contexts.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return contexts.repartition(int(parts), "gram").sortWithinPartitions("gram").mapInArrow(releasing(run), MATCH)


def match_by_counting(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same result by counting window hashes (two 64-bit hashes each).

    A block of offsets has a common core; blocks whose core no other context
    of the gram has are done before single offsets are looked at."""
    reach = length - gram

    def counted(rows: DataFrame, start: str, size: F.Column, keys: list[str]) -> DataFrame:
        piece = F.substring("bytes", F.col(start) + 1, size)
        rows = rows.withColumn("_h", F.struct(F.xxhash64(piece, F.lit(1)), F.xxhash64(piece, F.lit(2))))
        same = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_h").alias("_g")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        on = F.col("_h") == F.col("_g")
        for k in keys:
            on = on & (F.col(k) == F.col(f"_{k}"))
        return rows.join(same, on, "left_semi").drop("_h")

    after = F.octet_length("bytes") - F.col("before")
    rows = contexts.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(reach // OFFSET_BLOCK))))
    rows = rows.withColumn("_low", F.col("_block") * OFFSET_BLOCK).withColumn("_high", F.least(F.col("_low") + (OFFSET_BLOCK - 1), F.col("before")))
    rows = rows.withColumn("_low", F.greatest(F.col("_low"), F.lit(length) - after)).where("_low <= _high")
    # cores must be alike for all rows of a block: the block's nominal bounds
    nominal = rows.withColumn("_from", F.col("before") - F.col("_block") * OFFSET_BLOCK).withColumn("_size", F.lit(length - OFFSET_BLOCK + 1))
    nominal = counted(nominal, "_from", F.col("_size"), ["gram", "_block"])
    each = nominal.withColumn("_o", F.explode(F.sequence("_low", "_high"))).withColumn("_from", F.col("before") - F.col("_o"))
    each = counted(each, "_from", F.lit(length), ["gram", "_o"])
    return each.groupBy("gram", "context").agg(F.min("_o").cast("int").alias("low"), F.max("_o").cast("int").alias("high"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(text_key, spans): for each distinct text with repeats, its merged spans
    [start, stop) in bytes; one span (0, -1) stands for the whole text."""
    reach = length - gram
    all_anchors = stored(anchors(docs, text, length, gram), "passages-anchors")
    repeated = all_anchors.groupBy(F.col("gram").alias("_gram")).agg(F.min("place").alias("_a"), F.max("place").alias("_b")).where("_a <> _b").select("_gram")
    some = all_anchors.join(repeated, F.col("gram") == F.col("_gram"), "left_semi")
    some = stored(some.groupBy("text_key", "pos", "gram", "context", "place").agg(F.lit(1).alias("_")).drop("_"), "passages-repeated")
    discard(all_anchors)
    classes = some.groupBy("gram", "context").agg(F.min("place").alias("_a"), F.max("place").alias("_b"), F.min(F.struct("place", "text_key", "pos")).alias("_one"))
    classes = stored(classes.select("gram", "context", (F.col("_a") != F.col("_b")).alias("twice"), F.col("_one.text_key").alias("text_key"), F.col("_one.pos").alias("pos")), "passages-classes")
    mixed = classes.groupBy(F.col("gram").alias("_gram")).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.when(F.col("twice"), 0).otherwise(1)).alias("_open")).where("_n > 1 AND _open > 0")
    wanted = classes.join(mixed, F.col("gram") == F.col("_gram"))
    contexts = cut_contexts(docs, wanted, text, length, gram)
    sized = stored(contexts.join(mixed.select("_gram", "_n"), F.col("gram") == F.col("_gram")).drop("_gram"), "passages-contexts")
    few = match_in_tasks(sized.where(F.col("_n") <= group_rows).drop("_n"), length, gram)
    many = match_by_counting(sized.where(F.col("_n") > group_rows).drop("_n"), length, gram)
    whole = classes.where("twice").select("gram", "context", F.lit(0).alias("low"), F.lit(reach).alias("high"))
    open_classes = classes.where("NOT twice").select("gram", "context")
    matched = few.unionByName(many).join(open_classes.withColumnsRenamed({"gram": "_gram", "context": "_context"}), (F.col("gram") == F.col("_gram")) & (F.col("context") == F.col("_context")), "left_semi")
    windows = whole.unionByName(matched).withColumnsRenamed({"gram": "_gram", "context": "_context"})
    # a settled context may be cut short by its text's ends; spans are cut to the text where they are used
    marked = some.join(windows, (F.col("gram") == F.col("_gram")) & (F.col("context") == F.col("_context")))
    spans = marked.select("text_key", F.struct(F.greatest(F.col("pos") - F.col("high"), F.lit(0)).alias("start"), (F.col("pos") - F.col("low") + length).alias("stop")).alias("span"))
    copies = docs.select(text_key(text).alias("text_key"), F.octet_length(F.col(text)).alias("_n")).where(F.col("_n") >= length)
    copies = copies.groupBy("text_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    copies = copies.select("text_key", F.struct(F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("stop")).alias("span"))
    every = spans.unionByName(copies)
    out = stored(every.groupBy("text_key").agg(F.sort_array(F.collect_list("span")).alias("spans")), "passages-spans")
    discard(some, classes, sized)
    return out


def merged(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Sorted spans within a text of `size` bytes, touching ones merged."""
    out: list[list[int]] = []
    for start, stop in spans:
        stop = size if stop < 0 else min(stop, size)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def remove_repeats(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, return_text: bool = True,
    length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per row of `docs`: the columns `keep` (all by default; the text
    column then holds what is left, without characters that lost a byte), and
    n_bytes, n_removed, n_spans, kept_sha256. Kept columns that clash with a
    result give way to it."""
    results = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in [r.name for r in results]]
    spans = repeated_spans(docs, text, length, gram, group_rows).withColumnRenamed("text_key", "_key")
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep) if c != text], F.col(text).cast("binary").alias("_text"), text_key(text).alias("_own"))
    rows = rows.join(spans, F.col("_own") == F.col("_key"), "left").drop("_own", "_key")
    kinds = {f.name: f.dataType for f in docs.schema}
    out_fields = [T.StructField(f"c{i}", T.StringType() if c == text else kinds[c]) for i, c in enumerate(keep) if c != text or return_text]
    schema = T.StructType(out_fields + results)
    at_text = f"c{keep.index(text)}" if text in keep and return_text else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed, runs, digests = [], [], [], [], []
            for value, own in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                body = value or b""
                parts = merged([(s["start"], s["stop"]) for s in own or ()], len(body))
                left, at = [], 0
                for start, stop in parts:
                    left.append(body[at:start])
                    at = stop
                left = b"".join([*left, body[at:]])
                sizes.append(len(body))
                removed.append(len(body) - len(left))
                runs.append(len(parts))
                digests.append(hashlib.sha256(left).hexdigest())
                if at_text:
                    texts.append(None if value is None else b"".join([*[x.decode("utf-8", "ignore").encode() for x in pieces(body, parts)]]).decode())
            new = {"n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(runs, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            if at_text:
                new[at_text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else batch.column(f.name) for f in schema], names=[f.name for f in schema])

    out = rows.mapInArrow(releasing(cut), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep) if c != text or return_text], *[r.name for r in results])


def pieces(body: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    """What is left between the spans, each piece on its own."""
    out, at = [], 0
    for start, stop in spans:
        out.append(body[at:start])
        at = stop
    return [*out, body[at:]]
