"""Keyed stacking: several runs together give what one batch run gives."""

import glob
import json
import os
import random
import tempfile

import pytest

from darkroom.operators import stacks
from darkroom.plans.snapshots import latest_version, read_all
from darkroom.streaming.keyed_stacks import stream_stacks_keyed

PLAN = "base_name string, local_date_time string, asset_ids string, body string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _land(folder, name, items):
    os.makedirs(folder, exist_ok=True)
    rows = [{"id": i, "originalFileName": n, "localDateTime": t, "stackCount": c} for i, n, t, c in items]
    with open(f"{folder}/{name}.json", "w") as f:
        json.dump({"assets": {"items": rows, "nextPage": None}}, f)


def _plans(spark, base):
    if latest_version(spark, base) is None:
        return []
    return read_all(spark, base, spark.createDataFrame([], PLAN).schema).collect()


def _changes(checkpoint):
    return sum(os.path.getsize(p) for p in glob.glob(f"{checkpoint}/state/**/*.changelog", recursive=True))


def test_late_partners_and_repeated_listings(spark):
    base = tempfile.mkdtemp(prefix="darkroom-keyed-")
    land, plans, ckpt = f"{base}/land", f"{base}/plans", f"{base}/ckpt"
    _land(land, "p1", [("a1", "A.JPG", "t", None), ("b1", "B.JPG", "t", 0), ("m1", "M.JPG", "t", None), ("x", "", "t", None), ("y", "Y.JPG", None, None), (None, "A.RAF", "t", None)])
    stream_stacks_keyed(spark, land, plans, ckpt)
    assert _plans(spark, plans) == []
    # a partner of A, three of C, and M marked by the server before its partner comes
    _land(land, "p2", [("a1", "A.JPG", "t", None), ("a2", "A.RAF", "t", None), ("m1", "M.JPG", "t", 2), ("m2", "M.RAF", "t", None),
                       ("c3", "C.RAF", "t", None), ("c1", "C.jpeg", "t", None), ("c2", "C.CR2", "t", None), ("c1", "C.jpeg", "t", None)])
    stream_stacks_keyed(spark, land, plans, ckpt)
    assert sorted(r.asset_ids for r in _plans(spark, plans)) == ["a1,a2", "c1,c2,c3"]
    # everything again, unmarked: nothing new; late partners of a stack group among themselves
    _land(land, "p3", [("a1", "A.JPG", "t", None), ("a2", "A.RAF", "t", None), ("b1", "B.JPG", "t", None), ("c1", "C.jpeg", "t", None)])
    stream_stacks_keyed(spark, land, plans, ckpt)
    assert len(_plans(spark, plans)) == 2
    _land(land, "p4", [("b2", "B.RAF", "t", None), ("a3", "A.CR2", "t", None)])
    stream_stacks_keyed(spark, land, plans, ckpt)
    assert sorted(r.asset_ids for r in _plans(spark, plans)) == ["a1,a2", "b1,b2", "c1,c2,c3"]
    _land(land, "p5", [])
    stream_stacks_keyed(spark, land, plans, ckpt)
    assert len(_plans(spark, plans)) == 3


def test_two_runs_equal_the_batch_result_and_write_the_batch_only(spark):
    base = tempfile.mkdtemp(prefix="darkroom-keyed-")
    land, plans, ckpt = f"{base}/land", f"{base}/plans", f"{base}/ckpt"
    rng = random.Random(5)
    # a third of all assets share one key, which is complete in the first run
    hot = [(f"h{i}", f"HOT.{rng.choice(['JPG', 'RAF'])}", "t0", None) for i in range(400)]
    rest = [(f"r{i}", f"D{rng.randrange(500)}.{'JPG' if i % 2 else 'RAF'}", "t1", None) for i in range(800)]
    by_key: dict[str, list] = {}
    for row in rest:
        by_key.setdefault(row[1].split(".")[0], []).append(row)
    first, second = list(hot), []
    for rows in by_key.values():  # groups arrive whole, or as one asset and its one partner
        first += rows[:1] if len(rows) == 2 else rows
        second += rows[1:] if len(rows) == 2 else []
    second = second[:10]
    _land(land, "p1", first)
    stream_stacks_keyed(spark, land, plans, ckpt)
    written = _changes(ckpt)
    _land(land, "p2", second)
    stream_stacks_keyed(spark, land, plans, ckpt)
    kind = "asset_id string, original_file_name string, local_date_time string, stack_count int"
    whole = stacks.stack_requests(spark.createDataFrame(first + second, kind))
    want = sorted((r.base_name, r.local_date_time, r.asset_ids) for r in whole.collect())
    assert sorted((r.base_name, r.local_date_time, r.asset_ids) for r in _plans(spark, plans)) == want
    assert 0 < _changes(ckpt) - written < written / 5


def test_a_replayed_batch_asks_once_and_keeps_its_state(spark, monkeypatch):
    from darkroom.streaming import keyed_stacks

    base = tempfile.mkdtemp(prefix="darkroom-keyed-")
    land, plans, ckpt = f"{base}/land", f"{base}/plans", f"{base}/ckpt"
    _land(land, "p1", [("a1", "A.JPG", "t", None), ("a2", "A.RAF", "t", None), ("b1", "B.JPG", "t", None)])
    real = keyed_stacks.write_version

    def stops_after(*args, **options):
        real(*args, **options)
        raise RuntimeError("lost after the write")

    with monkeypatch.context() as m:
        m.setattr(keyed_stacks, "write_version", stops_after)
        with pytest.raises(Exception, match="lost after the write"):
            stream_stacks_keyed(spark, land, plans, ckpt)
    stream_stacks_keyed(spark, land, plans, ckpt)
    _land(land, "p2", [("b2", "B.RAF", "t", None), ("a1", "A.JPG", "t", None)])
    stream_stacks_keyed(spark, land, plans, ckpt)
    assert sorted(r.asset_ids for r in _plans(spark, plans)) == ["a1,a2", "b1,b2"]
