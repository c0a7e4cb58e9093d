"""BPE encoding by tree concatenation, and decoding.

The pre-tokenizer's units are independent of each other, so the distinct ones of a
chunk of texts are looked up once each and unknown ones are encoded by the
`tokenizers` library's model. Texts of Latin letters and common signs fall into
units by one regular expression, any other text into words that the whole library
call encodes. A long text (over `leaf`
characters) is cut at white space into parts that different tasks encode. A
stretch without white space that is longer than `leaf` is unsplit text: it is
cut blindly into leaves, which are encoded in parallel, and neighbours are joined
pairwise, round by round, as a tree. At each join

1. the pre-tokenizer is run again from the last unit of the left side that more
   text could change into a growing window of the right side, until one of its
   unit starts is also one of the right side's;
2. a unit that lies across the join is encoded again over a window of tokens that
   doubles until its first token is the left side's and its last token the right
   side's, and only the window's tokens are replaced.

Why that is exact: the pre-tokenizer looks at most two characters beyond where a
unit ends and never back, so equal starts go on alike. In BPE whose merges make
every token in one way, two tokens stay apart in any text if they stay apart on
their own, so a row of tokens is the encoding if each neighbouring pair occurs in
some encoding; agreeing on one token at each side of the window gives that.

Requires a tokenizer that drops white space, whose words are independent of each
other: `word_bpe_49k.json`. Special tokens in a text become their ids, as the
library does it; they end a stretch.

Defined results: a null or empty text has no ids and decodes to an empty text;
repeated rows are encoded one by one; an empty table gives none; other columns
are not read. A text of any length is whole in its own row of the result, as it
is in the input, and in no other.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.llm.bytetools import releasing
from darkroom.llm.store import stored

#: Characters beyond which unsplit text is cut; a long text's parts are about so long too.
LEAF = 1 << 16
#: Characters of text encoded together, and units that one task remembers (their
#: characters count too, so that the memory has a bound).
CHUNK_CHARS = 1 << 20
CACHE_UNITS = 300_000
CACHE_CHARS = 8 << 20
#: Tokens at each side of a join that are encoded again at first.
WINDOW = 4
#: A unit up to so many characters is encoded whole.
SMALL_UNIT = 256

#: Characters that normalisation only lower-cases and whose class is known: ASCII, Latin
#: letters, and signs; a text of them is cut into the pre-tokenizer's units by `UNITS`.
SIGNS = "!-/:-@\\[-`{-~¡-©«-±´¶-¸»¿×÷‐-‧"
SIMPLE = re.compile(f"[ \t-\r0-9A-Za-zÀ-ÖØ-öø-ÿ{SIGNS}]*")
UNITS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[{SIGNS}]+")

#: Control characters that Python's str.split takes for white space and the tokenizers do not.
SEPARATORS = re.compile("[\x1c-\x1f]")
WORDS = re.compile(r"(?:[^\s]|[\x1c-\x1f])+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def never_composed(c: str) -> bool:
    """Whether NFC never joins or reorders this character with the one before it:
    not a mark, nor a vowel or final of decomposed Hangul."""
    return c < "\u0300" or not unicodedata.category(c).startswith("M") and not "\u1160" <= c <= "\u11ff"


def words_of(text: str) -> list[str]:
    """Stretches without white space."""
    return WORDS.findall(text) if SEPARATORS.search(text) else text.split()


@dataclass
class Block:
    """The encoding of a stretch of normalised text: its units' places in the text
    and in the ids."""

    text: str
    ids: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    first: np.ndarray

    def tokens(self, unit: int) -> list[int]:
        stop = self.first[unit + 1] if unit + 1 < len(self.first) else len(self.ids)
        return self.ids[self.first[unit]:stop].tolist()

    def packed(self) -> tuple[str, bytes, bytes, bytes, bytes]:
        return self.text, self.ids.tobytes(), self.starts.tobytes(), self.stops.tobytes(), self.first.tobytes()

    @staticmethod
    def unpacked(text: str, ids: bytes, starts: bytes, stops: bytes, first: bytes) -> Block:
        return Block(text, np.frombuffer(ids, "<i4"), *(np.frombuffer(x, "<i8") for x in (starts, stops, first)))


class TreeCodec:
    """One tokenizer file, with the pieces that windows need."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark's tasks are the parallelism; the library's threads would only spin.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        plain = spec | {"normalizer": None, "added_tokens": []}
        self.plain = Tokenizer.from_str(json.dumps(plain))
        inner = plain | {"model": plain["model"] | {"end_of_word_suffix": None}}
        self.inner = Tokenizer.from_str(json.dumps(inner))
        size = self.whole.get_vocab_size()
        self.names = [self.whole.id_to_token(i) or "" for i in range(size)]
        suffix = len(spec["model"].get("end_of_word_suffix") or "")
        ends = spec["model"].get("end_of_word_suffix")
        self.width = [len(n) - suffix if ends and n.endswith(ends) else len(n) for n in self.names]
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in own]
        #: Each byte as the character that stands for it in a byte-level vocabulary.
        self.byte_chars = {b: b for b in own} | {b: 256 + n for n, b in enumerate(rest)}
        self.forget()

    # Units and words of ordinary length, through a cache that one task fills.

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.begin, self.held = array("i"), array("q", [0]), 0

    def keep(self, key: str, ids: list[int]) -> None:
        self.index[key] = len(self.begin) - 1
        self.flat.extend(ids)
        self.begin.append(len(self.flat))
        self.held += len(key)

    def learn(self, units: set[str], words: set[str]) -> None:
        for unit in units:
            piece = unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.byte_chars)
            self.keep(unit, self.unit(piece))
        fresh = [w for w in words if w not in self.index]
        for lot in (fresh[i:i + 4096] for i in range(0, len(fresh), 4096)):
            for word, e in zip(lot, self.whole.encode_batch_fast(lot, add_special_tokens=False), strict=True):
                self.keep(word, e.ids)

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; none may hold a very long stretch."""
        if len(self.index) > CACHE_UNITS or self.held > CACHE_CHARS:
            self.forget()
        simple = [SIMPLE.fullmatch(t) is not None and "<|" not in t for t in texts]
        lists = [UNITS.findall(t.lower()) if easy else words_of(t) for t, easy in zip(texts, simple, strict=True)]
        known = self.index
        new = [{w for words, easy in zip(lists, simple, strict=True) if easy is kind for w in words if w not in known} for kind in (True, False)]
        self.learn(*new)
        where = np.fromiter((known[w] for words in lists for w in words), np.int64)
        if not len(where):
            return [np.zeros(0, "<i4")] * len(texts)
        flat, begin = np.array(self.flat, dtype="<i4"), np.array(self.begin)
        size = (begin[1:] - begin[:-1])[where]
        upto = np.concatenate(([0], np.cumsum(size)))
        ids = flat[np.repeat(begin[where] - upto[:-1], size) + np.arange(upto[-1])]
        cut = upto[np.cumsum([0, *map(len, lists)])]
        return [ids[i:j] for i, j in zip(cut, cut[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode(ids, skip_special_tokens=False): this tokenizer
        has no decoder, so the tokens' own strings joined by one space."""
        names = self.names
        return " ".join([names[i] for i in ids.tolist()])

    # Unsplit text.

    def cuts(self, text: str, leaf: int) -> list[str]:
        """Leaves of a stretch. No cut parts what normalisation composes: it moves
        left to a character that starts anew, or right where there is none."""
        out, at = [], 0
        while len(text) - at > leaf:
            to = at + leaf
            while to > at and not never_composed(text[to]):
                to -= 1
            if to == at:
                to = at + leaf
                while to < len(text) and not never_composed(text[to]):
                    to += 1
            out.append(text[at:to])
            at = to
        if at < len(text) or not out:
            out.append(text[at:])
        return out

    def block(self, raw: str) -> Block:
        """The encoding of a stretch of text as if it stood alone."""
        text = self.whole.normalizer.normalize_str(raw) if self.whole.normalizer else raw
        units = self.plain.pre_tokenizer.pre_tokenize_str(text)
        ids = [self.unit(piece) for piece, _ in units]
        first = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64)))[:-1]
        places = np.asarray([s for _, s in units], dtype="<i8").reshape(-1, 2)
        flat = np.asarray([i for x in ids for i in x], dtype="<i4")
        return Block(text, flat, places[:, 0].copy(), places[:, 1].copy(), first.astype("<i8"))

    def unit(self, piece: str, ends: bool = True) -> list[int]:
        """ids of one unit in byte characters; `ends`: its end is a word's end."""
        return [t.id for t in (self.plain if ends else self.inner).model.tokenize(piece)]

    def across(self, piece: str, left: list[int], right: list[int]) -> list[int]:
        """ids of a unit whose first part was encoded as `left` and whose last
        part as `right`, by re-encoding a growing window of tokens between them."""
        if len(piece) <= SMALL_UNIT:
            return self.unit(piece)
        k = WINDOW
        while True:
            head, tail = max(0, len(left) - k), min(len(right), k)
            start = sum(self.width[i] for i in left[:head])
            stop = len(piece) - sum(self.width[i] for i in right[tail:])
            ids = self.unit(piece[start:stop], ends=tail == len(right))
            if (not head or ids[0] == left[head]) and (tail == len(right) or ids[-1] == right[tail - 1]):
                return left[:head] + ids + right[tail:]
            k *= 2

    def joined(self, a: Block, b: Block) -> Block:
        """The encoding of both texts together."""
        if not len(a.text) or not len(b.text):
            return a if len(a.text) else b
        end = len(a.text)
        # Units that more text cannot change: more than two characters follow their start, and one their end.
        open_units = np.flatnonzero((a.starts > end - 3) | (a.stops >= end))
        i = int(open_units[0]) if len(open_units) else len(a.starts)
        s = int(a.starts[i]) if i < len(a.starts) else end
        b_starts = {int(x): j for j, x in enumerate(b.starts)}
        grow = 64
        while True:
            whole = grow >= len(b.text)
            window = a.text[s:] + b.text[:grow]
            units = self.plain.pre_tokenizer.pre_tokenize_str(window)
            j = None
            for n, (_, (u, v)) in enumerate(units):
                if u >= end - s and u - (end - s) in b_starts:
                    j, units = b_starts[u - (end - s)], units[:n]
                    break
                if not whole and (u > len(window) - 3 or v >= len(window)):
                    break
            else:
                if whole:
                    j = len(b.starts)
            if j is not None:
                break
            grow = max(2 * grow, int(b.stops[0]) + 64 if len(b.stops) else 0)
        ids, starts, stops, first = [], [], [], []
        a_units = {int(x): n for n, x in enumerate(a.starts[i:], i)}
        b_stops = {int(x): n for n, x in enumerate(b.stops)}
        keep = int(a.first[i]) if i < len(a.first) else len(a.ids)
        for piece, (u, v) in units:
            m, n = a_units.get(s + u), b_stops.get(s + v - end)
            left = a.tokens(m) if m is not None and int(a.stops[m]) == end and s + v >= end else []
            right = b.tokens(n) if n is not None and s + u < end + int(b.starts[n]) and (not left or int(b.starts[n]) >= 0) else []
            starts.append(s + u)
            stops.append(s + v)
            first.append(keep + len(ids))
            ids += self.across(piece, left, right)
        skip = int(b.first[j]) if j < len(b.first) else len(b.ids)
        shift = keep + len(ids) - skip
        cat = lambda *x: np.concatenate([np.asarray(y, dtype="<i8") for y in x])
        return Block(
            a.text + b.text, np.concatenate([a.ids[:keep], np.asarray(ids, dtype="<i4"), b.ids[skip:]]),
            cat(a.starts[:i], starts, b.starts[j:] + end), cat(a.stops[:i], stops, b.stops[j:] + end), cat(a.first[:i], first, b.first[j:] + shift))

    # Long texts.

    def parts(self, text: str, leaf: int) -> Iterator[tuple[int, int, str]]:
        """(part, leaf, text) of a long text, in order: ordinary parts, cut at
        white space, have leaf -1; the leaves of an unsplit stretch share a part.
        Special tokens are ordinary parts, so that no cut goes through one."""
        part, lot, size = 0, [], 0
        for m in WORDS.finditer(text):
            word = m.group()
            if len(word) > leaf:
                if lot:
                    yield part, -1, " ".join(lot)
                    part, lot, size = part + 1, [], 0
                at = 0
                for hit in [*(self.special_re.finditer(word) if self.special_re else ()), None]:
                    run = word[at:hit.start() if hit else len(word)]
                    if run:
                        for n, x in enumerate(self.cuts(run, leaf)):
                            yield part, n, x
                        part += 1
                    if hit:
                        yield part, -1, hit.group()
                        part, at = part + 1, hit.end()
                continue
            lot.append(word)
            size += len(word) + 1
            if size > leaf:
                yield part, -1, " ".join(lot)
                part, lot, size = part + 1, [], 0
        if lot or not part:
            yield part, -1, " ".join(lot)


def ids_array(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, "<i4"), pa.int32()))


def lots(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters each."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


BLOCK = "row long, part int, leaf int, text string, ids binary, starts binary, stops binary, first binary"


def encode_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, leaf: int = LEAF) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row: the ids that the
    library gives its text, and those ids decoded."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema[doc_id].dataType
    out = T.StructType([T.StructField(doc_id, kind), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    docs = docs.select(F.col(doc_id), F.col(text).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in lots(texts, CHUNK_CHARS):
                ids = codec.encode_texts(texts[i:j])
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], ids_array(ids), pa.array([codec.decode(x) for x in ids], pa.string())], names=out.names)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(path)
        for batch in batches:
            for row, key, body in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                lot, size = [], 0
                for x in [*codec.parts(body, leaf), None]:
                    if lot and (x is None or size > CHUNK_CHARS):
                        n = len(lot)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row] * n, pa.int64()), pa.array([key.as_py()] * n, batch.schema[1].type), *(pa.array(c, t) for c, t in zip(zip(*lot, strict=True), (pa.int32(), pa.int32(), pa.string()), strict=True))],
                            names=["row", doc_id, "part", "leaf", "text"])
                        lot, size = [], 0
                    if x is not None:
                        lot.append(x)
                        size += len(x[2])

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(path)
        for batch in batches:
            row, part, number, bodies = (batch.column(i).to_pylist() for i in range(4))
            for i, body in enumerate(bodies):
                if number[i] < 0:
                    packed = (None, codec.encode_texts([body])[0].tobytes(), None, None, None)
                else:
                    packed = codec.block(body).packed()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[i]], pa.int64()), pa.array([part[i]], pa.int32()), pa.array([number[i]], pa.int32()), pa.array([packed[0]], pa.string()), *(pa.array([x], pa.binary()) for x in packed[1:])],
                    names=["row", "part", "leaf", "text", "ids", "starts", "stops", "first"])

    def join_pair(group: pa.Table) -> pa.Table:
        group = group.sort_by("leaf")
        codec = TreeCodec(path)
        a, b = (Block.unpacked(*(group.column(c)[i].as_py() for c in ("text", "ids", "starts", "stops", "first"))) for i in range(2))
        packed = codec.joined(a, b).packed()
        return pa.table(
            [group.column("row")[:1], group.column("part")[:1], pa.array([group.column("leaf")[0].as_py() // 2], pa.int32()), pa.array([packed[0]], pa.string()), *(pa.array([x], pa.binary()) for x in packed[1:])],
            names=["row", "part", "leaf", "text", "ids", "starts", "stops", "first"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(path)
        for batch in batches:
            for key, parts in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.concatenate([np.frombuffer(p, "<i4") for p in parts.as_py()])
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()], batch.schema[0].type), ids_array([ids]), pa.array([codec.decode(ids)], pa.string())], names=out.names)

    long = F.coalesce(F.length("_text") > leaf, F.lit(False))
    short = docs.where(~long).mapInArrow(releasing(encode), out)
    rows = docs.where(long).select(F.monotonically_increasing_id().alias("row"), doc_id, "_text")
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField(doc_id, kind), *(T.StructField(n, t) for n, t in (("part", T.IntegerType()), ("leaf", T.IntegerType()), ("text", T.StringType())))])
    cut = stored(rows.mapInArrow(releasing(split), schema), "bpe-parts")
    dealt = cut.select("row", "part", "leaf", "text").repartition("row", "part", "leaf")
    done = stored(dealt.mapInArrow(releasing(encode_parts), BLOCK), "bpe-blocks")

    # The tree: neighbours 2n and 2n+1 of an unsplit stretch become block n of the next round.
    while True:
        last = done.agg(F.max("leaf")).first()[0]
        if last is None or last < 1:
            break
        pair = Window.partitionBy("row", "part", F.shiftright("leaf", 1))
        sized = done.where("leaf >= 0").withColumn("_mates", F.count(F.lit(1)).over(pair))
        pairs = sized.where("_mates = 2").drop("_mates").withColumn("_pair", F.shiftright("leaf", 1)).groupBy("row", "part", "_pair").applyInArrow(
            lambda group: join_pair(group), BLOCK)
        alone = sized.where("_mates = 1").drop("_mates").withColumn("leaf", F.shiftright("leaf", 1))
        done = stored(done.where("leaf < 0").unionByName(pairs).unionByName(alone), "bpe-blocks")

    ids = done.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "ids"))), lambda x: x["ids"]).alias("ids"))
    keys = cut.where("part = 0 and leaf <= 0").select(F.col("row").alias("_row"), doc_id)
    long_texts = keys.join(ids, F.col("_row") == F.col("row")).select(doc_id, "ids").mapInArrow(releasing(whole), out)
    return short.unionByName(long_texts)
