"""Conversation tries, BPE encoding by tree and tokenizer alignment against brute force."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest

from darkroom.llm import bpe_codec, conversation_trie, queries, token_alignment
from darkroom.llm.store import ship_package, stored

WORD = re.compile("[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, key string, pos string, words string"
DOCS = "doc_id long, text string, ids string, row string, pair string, n_a string"


def nodes_of(rows):
    """The trie of the contract, node by node."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            half = struct.unpack(">qq", hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16])
            convs[conv].append((turn is not None, turn or 0, role, half, text))
    convs = {c: [(role, text) for _, _, role, _, text in sorted(turns)] for c, turns in convs.items()}
    members, rebuilt = collections.defaultdict(list), {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    total = collections.defaultdict(lambda: [0, 0])
    for n in sorted(members, key=len, reverse=True):
        total[n][0] += not children[n]
        total[n][1] += (len(members[n]) - 1) * len(WORD.findall(n[-1][1])) if n else 0
        if n:
            total[n[:-1]][0] += total[n][0]
            total[n[:-1]][1] += total[n][1]
    out = set()
    for n, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if rebuilt[c] == n)))
        out.add((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], *total[n], hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("band", [2, 8])
def test_conversation_trie(spark, band, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(conversation_trie, "BLOCK_IDS", 7)
    rnd = random.Random(band)
    rows = []
    for c in [*range(50), -7, -20, 400, 417]:
        for t in range(rnd.choice([1, 2, 3, 5, 9, 40]) if c not in (40, 60) else 0):
            rows.append((c, rnd.choice([t, t, None]), rnd.choice(["user", "assistant", None]), rnd.choice(["a", "a b", None, "", "c d e"])))
    rows += [(3, 1, "user", "a"), (3, 1, "user", "a"), (None, 1, "x", "y"), (7000, 0, "user", "long " * 100_000)]
    rows += [(1000 + i, t, "user", "the same") for i in range(60) for t in range(20)]
    turns = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS).repartition(3)
    got = conversation_trie.conversation_trie(*conversation_trie.spliced(conversation_trie.numbered_turns(turns)), band=band).drop("key")
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == nodes_of(rows)


def test_conversation_trie_without_turns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie.conversation_trie(*conversation_trie.spliced(conversation_trie.numbered_turns(empty))).isEmpty()


PIECES = ["a", "b", "the", "tion", "'", "s", "'re", "'ll", "9", "1", "!", "!!", "é", "é", "ß", "İ", "̧", "漢", "字", "한", "ᄒ", "ᅡ", "ᆫ",
          "aaaa", "\U0001f600", "Σ", "ς", "　", "\x1c", "<|endoftext|>", "<|", "|>", " ", "\n", "'", "S", "É", "À ", "ﬁ", "–", "’", "«", "²", "ª", "µ", "×", "_", "\xad", "\xa0"]


def test_tree_joins_equal_the_library():
    codec = bpe_codec.TreeCodec(bpe_codec.default_tokenizer())
    rnd = random.Random(8)
    for n in range(800):
        pool = rnd.sample(PIECES, rnd.randint(1, 6)) if n % 3 else PIECES
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(1, 1500 if n % 20 == 0 else 120)))
        stretches, done = collections.defaultdict(list), {}
        for part, leaf, body in codec.parts(text, rnd.choice([3, 5, 17, 64])):
            if leaf < 0:
                done[part] = codec.encode_texts([body])[0].tolist()
            else:
                stretches[part].append(codec.block(body))
        for part, blocks in stretches.items():
            while len(blocks) > 1:
                blocks = [codec.joined(*blocks[i:i + 2]) if i + 1 < len(blocks) else blocks[i] for i in range(0, len(blocks), 2)]
            done[part] = blocks[0].ids.tolist()
        assert [i for part in sorted(done) for i in done[part]] == codec.whole.encode(text, add_special_tokens=False).ids, text


def texts(rnd, pool, n):
    out = [(i, "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 80)))) for i in range(n)]
    return [*out, (5000, None), (5001, ""), (5002, "a▁b"), (5003, " "), (5004, "  lead"), (5005, "trail  "), (7, out[7][1]), (7, out[7][1]), (None, "x y z"), (8000, "the words of " * 30_000)]


def table_of(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", "z", "w") for d, t in rows], DOCS).repartition(4)


def test_encode_documents(spark):
    ship_package(spark)
    rnd = random.Random(4)
    rows = texts(rnd, [*PIECES, "thing ", "word "], 120)
    rows += [(9000 + k, "".join(rnd.choice(["tion", "er", "q", "é"]) for _ in range(k))) for k in (50, 300, 3000)]
    got = bpe_codec.encode_documents(table_of(spark, rows), leaf=90).collect()
    library = bpe_codec.TreeCodec(bpe_codec.default_tokenizer()).whole
    expected = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((d, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=str) == sorted(expected, key=str)
    assert bpe_codec.encode_documents(table_of(spark, [])).isEmpty()


def aligned(rows):
    aligner = token_alignment.Aligner(*token_alignment.default_tokenizers())
    docs, count = [], collections.Counter()
    for d, t in rows:
        raw = (" " + (t or "")).encode()
        a = aligner.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = aligner.b.encode(t) if t else []
        a_end = {int(e): i for i, e in enumerate(np.cumsum([len(aligner.a_bytes[x]) for x in a]))}
        b_end = {int(e): i for i, e in enumerate(np.cumsum([len(aligner.b_bytes[x]) for x in b]))}
        if b"".join(aligner.a_bytes[x] for x in a) != raw or b"".join(aligner.b_bytes[x] for x in b) != raw:
            a, b, a_end, b_end = [], [], {}, {}
        groups, x, y = [], 0, 0
        for e in sorted(a_end.keys() & b_end.keys()):
            groups.append((a[x:a_end[e] + 1], b[y:b_end[e] + 1]))
            x, y = a_end[e] + 1, b_end[e] + 1
        links = [(g[-1], h[-1]) for g, h in groups]
        count.update(links)
        docs.append((d, len(a), len(b), groups, links))
    best = collections.Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    for d, n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        yield d, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), text


def test_align_documents(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(token_alignment, "HELD_PAIRS", 50)
    monkeypatch.setattr(token_alignment, "CHUNK_CHARS", 5000)
    pool = ["a", " b", " ", "  ", "the", " tion", "'s", "9", " 1", "!", "...", "\n", "\n\n", "\t", "é", "漢字", " Hello", "World", "<|endoftext|>", "<s>", "<unk>", "<0x0A>",
            "\U0001f600", "\x00", "\x1c", "　", "\xa0", "İ", "́"]
    rows = texts(random.Random(6), pool, 400) + [(6000 + i, "plain words here and there") for i in range(50)]
    got = token_alignment.score_links(stored(token_alignment.align_documents(table_of(spark, rows)), "test-links")).collect()
    found = sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got), key=str)
    assert found == sorted(aligned(rows), key=str)
    assert token_alignment.score_links(stored(token_alignment.align_documents(table_of(spark, [])), "test-links")).isEmpty()


def test_registered_digests(spark):
    """The queries' digest columns on the smallest tables."""
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    library = bpe_codec.TreeCodec(bpe_codec.default_tokenizer()).whole
    expected = set()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.add((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in queries.op12_tree_codec(spark, sf).collect()} == expected
    got = queries.op13_token_alignment(spark, sf).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert {tuple(r) for r in got} == {(*r[:-1], sha(r[-1]) if r[-1] else "") for r in aligned(rows)}
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in queries.op11_conversation_trie(spark, sf).collect()} == nodes_of(turns)
