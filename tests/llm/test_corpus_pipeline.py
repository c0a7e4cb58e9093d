"""Every stage of the corpus pipeline against brute force on its own input, and
`run`, over documents whose own columns are named like results of the operators."""

import collections
import functools
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")
from darkroom.llm import best_fit_packing, quality_rules  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, source string, lang string, n_chars long, score double, n_bytes string, kept string, `a.b` string"


def make_texts(rnd):
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    texts = [" ".join(word() for _ in range(rnd.randint(60, 140))) for _ in range(40)]
    passage = " ".join(word() for _ in range(80))
    near = texts[0].split()
    for i in range(6):
        other = list(near)
        other[rnd.randrange(len(other))] = f"x{i}"
        texts.append(" ".join(other))
    texts += [texts[1]] * 3 + [t + " " + passage + " " + " ".join(word() for _ in range(200)) for t in texts[3:6]]
    junk = ["zz " + " ".join("".join(rnd.choices("qrst", k=4)) for _ in range(120)) for _ in range(10)]
    return [*texts, *junk, "too short", "", None, "same line\n" * 60, " ".join(word() for _ in range(6000))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    texts = make_texts(random.Random(12))
    rows = [(i, t, ["s0", "s1", None][i % 3], "en", len(t or ""), i / 8, f"b{i}", None, "dot") for i, t in enumerate(texts)]
    rows += [(None, texts[7] + " more words at the end", "s0", None, 5, None, None, "k", None), rows[9], rows[9]]
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 40)) for i in [*range(30), *range(52, 62)]]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def grams(text):
    words = [w.encode() for w in WORD.findall(text or "")]
    one = [xxhash.xxh64_intdigest(w, 42) for w in words]
    two = [xxhash.xxh64_intdigest(b, h) for h, b in zip(one, words[1:], strict=False)]
    return [signed(h) % quality_rules.BUCKETS for h in one + two]


def base_failed(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    marked = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
    return len(words) < 50 or 100 * len(marked) > 50 * len(words)


def test_quality_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = rows_of(docs)
    labels = dict(spark.read.parquet(f"{folder}/labels.parquet").collect())
    every = [(r, grams(r[1])) for r in rows]
    raw = collections.Counter(g for _, gs in every for g in gs)
    target = collections.Counter(g for r, gs in every if labels.get(r[0]) == 1 for g in gs)
    share = lambda c, g: math.log((c[g] + quality_rules.SMOOTHING) / (c.total() + quality_rules.SMOOTHING * quality_rules.BUCKETS))
    score = [np.mean([share(target, g) - share(raw, g) for g in gs]) if gs else 0.0 for _, gs in every]
    passing = [(r, s) for (r, _), s in zip(every, score, strict=True) if not base_failed(r[1])]
    low = np.percentile([s for r, s in passing if labels.get(r[0]) == 1], 0.1)
    high = np.percentile([s for r, s in passing if labels.get(r[0]) == 0], 95)
    limit = min(low, (low + high) / 2)
    assert min(abs(s - limit) for _, s in passing) > 1e-12
    got = pipeline.quality(spark, docs, folder)
    assert got.columns == docs.columns and rows_of(got) == sorted((r for r, s in passing if s >= limit), key=repr)
    assert 30 < len(rows_of(got)) < len(rows)


def test_quality_stage_fits_on_every_labelled_document(spark, tmp_path):
    """Over 20,000 labelled good documents: none may be left out."""
    rnd = random.Random(21)
    words = [f"w{k}" for k in range(200)]
    texts = [" ".join(rnd.choices(words, k=55)) for _ in range(31_000)]
    labels = {i: int(i < 30_000) for i in range(30_600)}
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels.items()), "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    hashed = functools.cache(lambda a, b=None: signed(xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) if b else xxhash.xxh64_intdigest(a, 42)) % quality_rules.BUCKETS)
    every = [[*map(hashed, w), *map(hashed, w, w[1:])] for w in (t.split() for t in texts)]
    assert sorted(every[0]) == sorted(grams(texts[0])) and not any(map(base_failed, texts))
    raw = np.bincount(np.concatenate(every), minlength=quality_rules.BUCKETS) + quality_rules.SMOOTHING
    target = np.bincount(np.concatenate(every[:30_000]), minlength=quality_rules.BUCKETS) + quality_rules.SMOOTHING
    weight = np.log(target / target.sum()) - np.log(raw / raw.sum())
    score = np.array([weight[g].mean() for g in every])
    low, high = np.percentile(score[:30_000], 0.1), np.percentile(score[30_000:30_600], 95)
    limit = min(low, (low + high) / 2)
    assert min(abs(score - limit)) > 1e-12
    got = pipeline.quality(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == np.flatnonzero(score >= limit).tolist()


def test_near_duplicate_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = rows_of(docs)

    @functools.cache
    def shingles(text):
        w = WORD.findall(text or "")
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    texts = list(dict.fromkeys(r[1] or "" for r in rows))
    label = {t: t for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = shingles(a), shingles(b)
            if x and y and len(x & y) >= 0.8 * len(x | y) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = {t: new if own == old else own for t, own in label.items()}
    best = {}
    for r in rows:
        k = label[r[1] or ""]
        best[k] = min(best.get(k, (True, 0)), (r[0] is None, r[0] or 0))
    got = pipeline.near_duplicates(spark, docs, folder)
    assert got.columns == docs.columns
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(best) and set(found) <= set(rows)
    assert sorted((r[0] is None, r[0] or 0) for r in found) == sorted(best.values())


def test_repeated_passage_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = rows_of(docs)
    bodies = [(r[1] or "").encode() for r in rows]
    count = collections.Counter(b[i:i + 200] for b in bodies for i in range(len(b) - 199))
    expected = []
    for r, body in zip(rows, bodies, strict=True):
        mark = bytearray(len(body))
        for i in range(len(body) - 199):
            if count[body[i:i + 200]] > 1:
                mark[i:i + 200] = b"\1" * 200
        left, at = [], 0
        for i in range(len(body) + 1):
            if i == len(body) or mark[i]:
                left.append(body[at:i].decode("utf-8", "ignore"))
                at = i + 1
        text = None if r[1] is None else "".join(left)
        expected.append((r[0], text, *r[2:4], None if text is None else len(text), *r[5:]))
    got = pipeline.repeated_passages(spark, docs, folder)
    assert got.columns == docs.columns and rows_of(got) == sorted(expected, key=repr)


def test_mix_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    got = pipeline.source_mix(spark, docs, folder)
    assert got.columns == docs.columns
    times, have = collections.Counter(tuple(r) for r in got.collect()), collections.Counter(rows)
    assert all(n <= 2 * have[r] for r, n in times.items())
    size = lambda r: len(WORD.findall(r[1] or ""))
    sizes = collections.Counter()
    for r in rows:
        sizes[r[2]] += size(r)
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    level, target = 0.0, {}
    for s in sorted(names, key=lambda s: sizes[s] / weight[s]):
        rest = [x for x in names if x not in target]
        level = (1.5 * sum(sizes.values()) - sum(target.values())) / sum(weight[x] for x in rest)
        target[s] = min(2.0 * sizes[s], level * weight[s])
    for s in names:
        taken = sum(n * size(r) for r, n in times.items() if r[2] == s)
        assert abs(taken - target[s]) <= 2 * max(size(r) for r in rows if r[2] == s)


def test_packing_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = pipeline.packing(spark, docs, folder).collect()
    encoder = best_fit_packing.WordEncoder(best_fit_packing.default_tokenizer()).tokenizer
    want = collections.Counter()
    for r in docs.collect():
        ids = [*encoder.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k:k + 4096], "<u4")
            want[(r.doc_id, k // 4096, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    full = collections.Counter()
    for r in got:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 4096 and len(full) <= sum(full.values()) / 4096 * 1.05 + 1


def test_run_is_the_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        path = os.path.join(folder, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    last = pipeline.packing(spark, docs, folder)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert collections.Counter(map(key, pipeline.run(spark, folder).collect())) == collections.Counter(map(key, last.collect()))
