"""Best-fit packing of tokenised documents into fixed-length sequences.

Tokens are counted inside the tasks that read the texts, so no token moves
between tasks: only one row per piece (a document, or a cut of a longer one)
is stored. Pieces are dealt evenly over groups of bounded size, and each group
is packed by vector best fit, largest pieces first: a sequence has three
capacities (tokens, documents, attention cost as the sum of squared lengths);
among the sequences in which the piece fits under every one, the one whose
weighted residual norm after placing is least takes it (or, by choice, the one
with the greatest weighted dot product of demand and residual).

Defined results: a null text is empty, and an empty text still gives its end
token; repeated rows are packed one by one; an empty table gives none.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.llm.bytetools import chunks, mix, prefix_hash, releasing, span_hash, word_spans
from darkroom.llm.store import stored

MAX_TOKENS = 4096
MAX_DOCS = 4096
MAX_COST = 4096 * 4096
#: Weights of tokens, documents and attention cost in the residual norm.
WEIGHTS = (1.0, 0.01, 0.01)
END_TOKEN = 1
#: A packing group holds about so many sequences' worth of tokens, and at most about so many pieces.
GROUP_SEQUENCES = 1500
GROUP_PIECES = 50_000
#: Entries of a worker's caches of words and of runs before they start anew.
CACHE_WORDS = 200_000
CACHE_RUNS = 300_000
#: Bytes of text encoded together.
CHUNK_BYTES = 2 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """ids of texts (UTF-8 bytes) as little-endian unsigned 32-bit arrays.

    This tokenizer drops white space and never joins across it, so a text's
    ids are its words' ids in order. The distinct words of a chunk of texts are
    found by 64-bit hash, looked up once each in a bounded cache, and gathered
    back. A word of Latin letters with plain punctuation around it falls into
    the same runs that the tokenizer's own splitting makes, so runs are encoded
    many at a time and cached without case; any other word is encoded whole.
    A test compares whole texts."""

    PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
    LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

    def __init__(self, path: str, words: int = CACHE_WORDS, runs: int = CACHE_RUNS):
        from tokenizers import Tokenizer

        # Spark's tasks are the parallelism; each library thread would keep memory of its own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[bytes, bytes] = {}
        self.max_words, self.max_runs = words, runs

    def split(self, word: bytes) -> list[bytes] | None:
        """The word's runs, or None if it must be encoded whole."""
        core = word.strip(self.PUNCTUATION)
        if core.isalpha():
            low = core.lower()
        elif not core:
            return None if b"<|" in word else [word]
        elif self.LATIN.fullmatch(core.decode()):
            low = core.decode().lower().encode()
        else:
            return None
        if len(core) == len(word):
            return [low]
        at = word.find(core)
        before, after = word[:at], word[at + len(core):]
        if b"<|" in before or b"<|" in after:
            return None
        return [r for r in (before, low, after) if r]

    def learn(self, words: list[bytes]) -> None:
        """Encode new words, their new runs many to a call."""
        if len(self.runs) > self.max_runs:
            self.runs.clear()
        known = self.runs
        parts = [self.split(w) for w in words]
        new = list({r for runs in parts for r in runs or () if r not in known})
        lots = [new[i:i + 500] for i in range(0, len(new), 500)]
        for lot, e in zip(lots, self.tokenizer.encode_batch_fast([b" ".join(x).decode() for x in lots], add_special_tokens=False), strict=True):
            ids = np.asarray(e.ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(lot):
                raise ValueError("a run is not one unit of this tokenizer")
            raw, stops = ids.tobytes(), [0, *(4 * stops).tolist()]
            known.update(zip(lot, [raw[i:j] for i, j in zip(stops, stops[1:], strict=False)], strict=True))
        for word, runs in zip(words, parts, strict=True):
            if runs is None:
                self.words[word] = np.asarray(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
            else:
                self.words[word] = known[runs[0]] if len(runs) == 1 else b"".join([known[r] for r in runs])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        whole = b"\n".join(texts)
        data = np.frombuffer(whole, dtype=np.uint8)
        starts, stops = word_spans(data)
        if not len(starts):
            return [np.zeros(0, "<u4")] * len(texts)
        _, first, which = np.unique(mix(span_hash(prefix_hash(data), starts, stops)), return_index=True, return_inverse=True)
        words = [whole[i:j] for i, j in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        if len(self.words) > self.max_words:
            self.words.clear()
        self.learn([w for w in words if w not in self.words])
        each = [self.words[w] for w in words]
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        blob = np.frombuffer(b"".join(each), "<u4")
        begin = np.cumsum(sizes) - sizes
        size = sizes[which]
        upto = np.cumsum(size)
        ids = blob[np.repeat(begin[which] - (upto - size), size) + np.arange(upto[-1])]
        texts_at = np.cumsum([0] + [len(t) + 1 for t in texts])
        cut = np.concatenate(([0], upto))[np.searchsorted(starts, texts_at)]
        return [ids[i:j] for i, j in zip(cut, cut[1:], strict=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One tokenizer per worker process; a task forgets its words at its end."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def piece_table(docs: DataFrame, doc_id: str, text: str, tokenizer: str, max_tokens: int, end_token: int) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of every document."""
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        encoder.words, encoder.runs = {}, {}
        end = np.asarray([end_token], dtype="<u4")
        for batch in batches:
            source, piece, start, length, crc = [], [], [], [], []
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for lot in chunks(texts, CHUNK_BYTES):
                for i, ids in zip(lot, encoder.encode([texts[i] for i in lot]), strict=True):
                    ids = np.concatenate([ids, end])
                    for k, at in enumerate(range(0, len(ids), max_tokens)):
                        part = ids[at:at + max_tokens]
                        source.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
            take = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(take), batch.column("doc_id").take(take), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    def cut_and_forget(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from cut(batches)
        encoder = encoder_of(tokenizer)
        encoder.words, encoder.runs = {}, {}

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(releasing(cut_and_forget), schema)


def vector_best_fit(
    lengths: np.ndarray, max_tokens: int = MAX_TOKENS, max_docs: int = MAX_DOCS, max_cost: int = MAX_COST,
    weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; the pieces go largest first, then in order.

    Open bins are rows of one residual matrix in units of the capacities; a
    bin without room for one more token, document or cost leaves it."""
    capacity = np.array([max_tokens, max_docs, max_cost], dtype=float)
    w = np.asarray(weights) / capacity
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left = np.empty((1024, 3))
    ids = np.empty(1024, np.int64)
    n = made = 0
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        open_left = left[:n]
        fits = np.flatnonzero((open_left >= need).all(axis=1))
        if len(fits):
            after = open_left[fits] - need
            if rule == "norm":
                at = fits[np.argmin((after * w) ** 2 @ np.ones(3))]
            else:
                at = fits[np.argmax(open_left[fits] @ (w * need / capacity))]
        else:
            if n == len(left):
                left, ids = np.concatenate([left, np.empty_like(left)]), np.concatenate([ids, np.empty_like(ids)])
            at, n = n, n + 1
            left[at], ids[at] = capacity, made
            made += 1
        bins[i], offsets[i] = ids[at], max_tokens - int(left[at, 0])
        left[at] -= need
        if left[at].min() < 1:
            n -= 1
            left[at], ids[at] = left[n], ids[n]
    return bins, offsets


def pack_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
    max_tokens: int = MAX_TOKENS, max_docs: int = MAX_DOCS, max_cost: int = MAX_COST,
    weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm", end_token: int = END_TOKEN,
    group_sequences: int = GROUP_SEQUENCES, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per
    piece. A piece must fit an empty sequence: `max_cost` at least max_tokens**2."""
    if max_cost < max_tokens ** 2 or max_docs < 1:
        raise ValueError("a whole piece must fit an empty sequence")
    pieces = stored(piece_table(docs, doc_id, text, tokenizer or default_tokenizer(), max_tokens, end_token), "pack-pieces")
    tokens, rows = pieces.agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = max(1, -(-(tokens or 0) // (max_tokens * group_sequences)), -(-rows // group_pieces))
    schema = T.StructType([f for f in pieces.schema if f.name != "row"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in schema]

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row", "piece"], kind="stable")
        bins, offsets = vector_best_fit(group["length"].to_numpy(), max_tokens, max_docs, max_cost, weights, rule)
        return group.assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)[names]

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(pack, schema).withColumnRenamed("doc_id", doc_id)
