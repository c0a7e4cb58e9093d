"""Alignment of two tokenizers' tokens with an identity-map fast path.

A is byte-level BPE, B sentencepiece BPE with byte fallback. Both see a space and
the text, and a piece of a text that begins at a single space between two other
characters is tokenised the same alone or in its text: neither vocabulary has a
token with a space after another character. So texts fall into words, and each
distinct word of a chunk is tokenised and aligned once; its groups are cut at the
byte offsets where an A and a B token both end.

A link is the last A and last B token of a group. Links of one A and one B token
are fast: `identity` maps every A id to the B id of the same bytes, so the A id
alone names the link, and tasks count them in a vector as long as A's vocabulary,
summed over the tasks. Only the other links are counted by a shuffle on the pair
of ids. Scores need every pair's count and the highest count of every B id: the
vector and the highest counts are as long as the vocabularies, whatever the
corpus, and go to every task; counts of the other pairs, which may be many, are
joined.

Defined results: a text that is null, empty or not given back by either
tokenizer's bytes has no tokens, zeros and an empty string, and adds no links;
repeated rows are aligned one by one and all count; an empty table gives none;
other columns are not read. Very long texts are cut into words like any other; a
stretch without single spaces is tokenised whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.llm.bytetools import releasing
from darkroom.llm.store import stored

#: Characters of text aligned together, and words that one task remembers (their
#: characters count too, so that the memory has a bound).
CHUNK_CHARS = 1 << 20
CACHE_WORDS = 300_000
CACHE_CHARS = 4 << 20
#: Words given to a tokenizer as one text.
LOT = 250
#: Pairs that a task holds before it sums them up.
HELD_PAIRS = 1 << 20
#: A single space with something else at both sides.
GAP = re.compile(r"(?<=\S) (?=\S)")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@cache
def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters are themselves, the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class Aligner:
    """Two tokenizers, their tokens' bytes, and the identity map between them."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        # Spark's tasks are the parallelism; the library's threads would only spin.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        value = byte_values()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        of_bytes: dict[bytes, int] = {}
        for i, raw in enumerate(self.b_bytes):
            if not self.b.is_control(i) and not self.b.is_unknown(i) and (raw not in of_bytes or self.b.is_byte(of_bytes[raw])):
                of_bytes[raw] = i
        #: B's id of the same bytes for each A id, or -1.
        self.identity = np.array([of_bytes.get(x, -1) for x in self.a_bytes], dtype=np.int64)
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")
        self.fast, self.fast_at = array("q"), array("q", [0])
        self.slow, self.slow_at = array("q"), array("q", [0])
        self.held = 0

    def tokens(self, words: list[str]) -> tuple[list[int], list[int], list[int]]:
        """The words whose bytes both tokenizers give back, by number, and their A
        and B ids. Words are joined by spaces for the call; one by one go those
        with white space at an end, and those of a lot that is not given back."""
        alone = [i for i, w in enumerate(words) if not w.strip() or w[0].isspace() or w[-1].isspace()]
        rest = sorted(set(range(len(words))).difference(alone))
        lots = [rest[i:i + LOT] for i in range(0, len(rest), LOT)] + [[i] for i in alone]
        good, a, b = [], [], []
        while lots:
            texts = [" ".join([words[i] for i in lot]) for lot in lots]
            again = []
            for lot, text, e, y in zip(lots, texts, self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False), self.b.encode(texts, num_threads=1), strict=True):
                x, raw = e.ids, b" " + text.encode()
                if raw == b"".join([self.a_bytes[i] for i in x]) == b"".join([self.b_bytes[i] for i in y]):
                    good += lot
                    a += x
                    b += y
                elif len(lot) > 1:
                    again += [[i] for i in lot]
            lots = again
        return good, a, b

    def learn(self, words: list[str]) -> None:
        """Align new words; one that is not given back has no tokens."""
        good, a, b = self.tokens(words)
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        a_ends, b_ends = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        # Good words have as many bytes on both sides, so offsets over all of them agree.
        ends, at_a, at_b = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        word_ends = np.cumsum([1 + len(words[i].encode()) for i in good], dtype=np.int64)
        a_from, b_from = (np.concatenate(([0], at + 1))[:len(at)] for at in (at_a, at_b))
        last_a, last_b = a[at_a], b[at_b]
        plain = (at_a == a_from) & (at_b == b_from) & (self.identity[last_a] == last_b)
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups = [
            f"{a_text[i]}|{b_text[k]}" if i == j and k == m else f"{','.join(a_text[i:j + 1])}|{','.join(b_text[k:m + 1])}"
            for i, j, k, m in zip(a_from.tolist(), at_a.tolist(), b_from.tolist(), at_b.tolist(), strict=True)]
        cut = np.concatenate(([0], np.searchsorted(ends, word_ends, side="right")))
        ones = np.concatenate(([0], np.cumsum(plain)))[cut]
        rest = cut - ones
        for i, g, h in zip(good, cut.tolist(), cut[1:].tolist(), strict=False):
            self.index[words[i]] = len(self.groups)
            self.groups.append(";".join(groups[g:h]))
        for column, counts in ((self.n_a, np.diff(np.searchsorted(a_ends, word_ends, side="right"), prepend=0)), (self.n_b, np.diff(np.searchsorted(b_ends, word_ends, side="right"), prepend=0)), (self.n_groups, np.diff(cut))):
            column.extend(counts.tolist())
        self.fast_at.extend((ones[1:] + len(self.fast)).tolist())
        self.slow_at.extend((rest[1:] + len(self.slow)).tolist())
        self.fast.extend(last_a[plain].tolist())
        self.slow.extend((last_a << 32 | last_b)[~plain].tolist())
        for i in set(range(len(words))).difference(good):
            self.index[words[i]] = len(self.groups)
            self.groups.append("")
            for column in (self.n_a, self.n_b, self.n_groups):
                column.append(0)
            self.fast_at.append(len(self.fast))
            self.slow_at.append(len(self.slow))
        self.held += sum(map(len, words))

    def align_texts(self, texts: list[str]) -> tuple:
        """Lists by text: n_a, n_b, n_groups, groups; then one (offsets, ids, times)
        for one-to-one links by A id and one for the others by A << 32 | B."""
        if len(self.index) > CACHE_WORDS or self.held > CACHE_CHARS:
            self.forget()
        lists = [GAP.split(t) if t else [] for t in texts]
        known = self.index
        self.learn(list({w for words in lists for w in words if w not in known}))
        n_a = np.array(self.n_a)
        found = [[known[w] for w in words] for words in lists]
        found = [x if n_a[x].all() else [] for x in found]
        where = np.array([i for x in found for i in x], dtype=np.int64)
        cut = np.cumsum([0, *map(len, found)])
        per_text = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[cut])
        counts = [per_text(np.array(c, dtype=np.int64)[where]) for c in (self.n_a, self.n_b, self.n_groups)]
        groups = [";".join([self.groups[i] for i in x]) for x in found]
        return *counts, groups, *(self.times(np.array(flat, dtype=np.int64), np.array(at, dtype=np.int64), where, cut) for flat, at in ((self.fast, self.fast_at), (self.slow, self.slow_at)))

    @staticmethod
    def times(flat: np.ndarray, at: np.ndarray, where: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct values of each text's words and how often each occurs."""
        size = (at[1:] - at[:-1])[where]
        upto = np.concatenate(([0], np.cumsum(size)))
        values = flat[np.repeat(at[where] - upto[:-1], size) + np.arange(upto[-1])]
        kinds, number = np.unique(values, return_inverse=True)
        text = np.repeat(np.arange(len(cut) - 1), np.diff(upto[cut]))
        key, n = np.unique(text * max(1, len(kinds)) + number, return_counts=True)
        text, number = np.divmod(key, max(1, len(kinds)))
        return np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(cut) - 1)))), kinds[number], n


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, groups (`a1,a2|b1;a3|b2,b3`)
    and its links: fast_ids and fast_n (A ids of one-to-one groups and how often),
    slow_pairs and slow_n (A << 32 | B of the others)."""
    a, b = a or default_tokenizers()[0], b or default_tokenizers()[1]
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType), *(T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups")), T.StructField("groups", T.StringType()),
        T.StructField("fast_ids", T.ArrayType(T.IntegerType())), T.StructField("fast_n", T.ArrayType(T.LongType())),
        T.StructField("slow_pairs", T.ArrayType(T.LongType())), T.StructField("slow_n", T.ArrayType(T.LongType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            first = size = 0
            for i, text in enumerate(texts):
                size += len(text) + 1
                if size > CHUNK_CHARS or i == len(texts) - 1:
                    n_a, n_b, n_groups, groups, *links = aligner.align_texts(texts[first:i + 1])
                    lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, kind)) for (at, ids, n), id_kind in zip(links, (pa.int32(), pa.int64()), strict=True) for x, kind in ((ids, id_kind), (n, pa.int64()))]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[first:i + 1], *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(groups, pa.string()), *lists], names=schema.names)
                    first, size = i + 1, 0

    return docs.select(F.col(doc_id), F.col(text).alias("_text")).mapInArrow(releasing(rows), schema)


def pair_counts(links: DataFrame, a: str, b: str) -> DataFrame:
    """(pair, fast, n): how many links of the corpus hold each pair of ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b)
        vector = np.zeros(len(aligner.identity), np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(pairs: np.ndarray, n: np.ndarray, fast: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(np.full(len(pairs), fast)), pa.array(n, pa.int64())], names=["pair", "fast", "n"])

        def summed() -> tuple[np.ndarray, np.ndarray]:
            pairs, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, at, np.concatenate([m for _, m in held]))
            return pairs, n

        for batch in batches:
            ids, ids_n, pairs, pairs_n = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
            np.add.at(vector, ids, ids_n)
            if len(pairs):
                held.append((pairs, pairs_n))
            if sum(len(x) for x, _ in held) > HELD_PAIRS:
                held = [summed()]
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield out(*held.pop(), False)
        if held:
            yield out(*summed(), False)
        ids = np.flatnonzero(vector)
        yield out(ids << 32 | aligner.identity[ids], vector[ids], True)

    counted = links.select("fast_ids", "fast_n", "slow_pairs", "slow_n").mapInArrow(releasing(count), "pair long, fast boolean, n long")
    return counted.groupBy("pair", "fast").agg(F.sum("n").alias("n"))


def score_links(links: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Replace the link columns of a stored table of `align_documents` by n_links,
    n_best (links whose pair is the most frequent of its B id, ties included) and
    count_sum (their pairs' counts summed)."""
    a, b = a or default_tokenizers()[0], b or default_tokenizers()[1]
    counts = stored(pair_counts(links, a, b), "align-counts")
    b_of = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    best = counts.groupBy(b_of.alias("b")).agg(F.max("n").alias("most"))
    # Both are bounded by the vocabularies: a row per id of A or of B.
    vector = [(r.pair >> 32, r.n) for r in counts.where("fast").select("pair", "n").collect()]
    most = [tuple(r) for r in best.collect()]
    keep = [f for f in links.schema if f.name not in ("fast_ids", "fast_n", "slow_pairs", "slow_n")]
    schema = T.StructType([*keep, T.StructField("_row", T.LongType()), *(T.StructField(n, T.LongType()) for n in ("_fast_best", "_fast_sum")), T.StructField("slow_pairs", T.ArrayType(T.LongType())), T.StructField("slow_n", T.ArrayType(T.LongType()))])

    def fast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b)
        count, highest = np.zeros(len(aligner.identity), np.int64), np.zeros(len(aligner.b_len), np.int64)
        for i, n in vector:
            count[i] = n
        for i, n in most:
            highest[i] = n
        hit = (count > 0) & (count == highest[aligner.identity])
        for batch in batches:
            ids_list, ids_n = batch.column("fast_ids"), batch.column("fast_n")
            ids, n = ids_list.flatten().to_numpy(zero_copy_only=False), ids_n.flatten().to_numpy(zero_copy_only=False)
            size = np.array(ids_list.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            upto = np.concatenate(([0], np.cumsum(size)))
            per_doc = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[upto])  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in keep), batch.column("_row"), pa.array(per_doc(n * hit[ids]), pa.int64()), pa.array(per_doc(n * count[ids]), pa.int64()), batch.column("slow_pairs"), batch.column("slow_n")],
                names=schema.names)

    rows = stored(links.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(releasing(fast), schema), "align-rows")
    slow = rows.select("_row", F.explode(F.arrays_zip("slow_pairs", "slow_n")).alias("link")).select("_row", F.col("link.slow_pairs").alias("pair"), F.col("link.slow_n").alias("times"))
    judged = counts.where("not fast").select(F.col("pair").alias("_pair"), "n", b_of.alias("b"))
    judged = judged.join(best.withColumnRenamed("b", "_b"), F.col("b") == F.col("_b")).select("_pair", "n", (F.col("n") == F.col("most")).alias("hit"))
    sums = slow.join(judged, F.col("pair") == F.col("_pair")).groupBy(F.col("_row").alias("_slow")).agg(
        F.sum(F.when(F.col("hit"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    out = rows.join(sums, F.col("_row") == F.col("_slow"), "left")
    return out.select(
        *[f.name for f in keep], F.col("n_groups").alias("n_links"),
        (F.col("_fast_best") + F.coalesce("_best", F.lit(0))).alias("n_best"), (F.col("_fast_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"))
