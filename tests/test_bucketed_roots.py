"""Merges on bucketed tables, and roots inside roots."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from darkroom import schemas
from darkroom.operators import merge
from darkroom.operators.roots import tag_by_root
from darkroom.plans.bucketed import forget, read_bucketed, write_bucketed

TS = "2024-02-01 00:00:00"
RESULT = "file_path string, s3_key string, source_type string, file_size long, md5_checksum string, status string"


def _ledger(spark, n):
    return spark.range(n).select(
        F.col("id"), F.concat(F.lit("/i/"), F.col("id").cast("string")).alias("file_path"), F.lit("k").alias("s3_key"), F.lit("internal").alias("source_type"),
        F.col("id").alias("file_size"), F.lit(TS).cast("timestamp_ntz").alias("uploaded_at"), F.lit(None).cast("timestamp_ntz").alias("last_verified_at"),
        F.lit("m").alias("md5_checksum"), F.lit("uploaded").alias("status"))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_bucketed_merge_moves_no_old_rows(spark, no_broadcast):
    base = tempfile.mkdtemp(prefix="darkroom-bucket-")
    old = _ledger(spark, 500)
    write_bucketed(old, f"{base}/v1", 6)
    ledger = read_bucketed(spark, f"{base}/v1", old.schema, 6)
    rows = [(f"/i/{i}", "new", "external", 7, "x", "uploaded" if i % 2 else "error") for i in (3, 4, 900, 901, 902)]
    results = spark.createDataFrame(rows, RESULT)
    merged = merge.merge_ledger(ledger, merge.number_inserts(ledger, results, 6), TS, assign_ids=False)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 6 out of 6" in plan
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert moved and not [line for line in moved if "o_file_path" in line]
    known = ledger.select(F.col("file_path").alias("_known"))
    anti = results.select("file_path").repartition(6, "file_path").join(known, F.col("file_path") == F.col("_known"), "left_anti")
    assert "hashpartitioning(_known" not in anti._jdf.queryExecution().executedPlan().toString()
    want = merge.merge_ledger(old, results, TS).orderBy("id").collect()
    assert merged.orderBy("id").select(*merge.LEDGER_COLUMNS).collect() == want
    # the next version comes out one file a bucket, without a shuffle of its own
    write_bucketed(merged, f"{base}/v2", 6)
    files = [f for f in os.listdir(f"{base}/v2") if f.endswith(".parquet")]
    assert len(files) <= 6
    again = read_bucketed(spark, f"{base}/v2", merged.schema, 6)
    assert again.count() == 503 and again.agg(F.max("id")).first()[0] == 502
    with pytest.raises(Exception, match="(?i)exists"):
        write_bucketed(merged, f"{base}/v2", 6)
    for v in ("v1", "v2"):
        forget(spark, f"{base}/{v}")
    assert spark.read.parquet(f"{base}/v2").count() == 503


def test_a_bucketed_merge_of_nothing(spark):
    base = tempfile.mkdtemp(prefix="darkroom-bucket-")
    empty = _ledger(spark, 0)
    write_bucketed(empty, f"{base}/v1", 4)
    ledger = read_bucketed(spark, f"{base}/v1", empty.schema, 4)
    none = spark.createDataFrame([], RESULT)
    assert merge.merge_ledger(ledger, merge.number_inserts(ledger, none), TS, assign_ids=False).count() == 0
    one = spark.createDataFrame([("/a", "k", "internal", 1, "m", "uploaded")], RESULT)
    assert [r.id for r in merge.merge_ledger(ledger, merge.number_inserts(ledger, one), TS, assign_ids=False).collect()] == [1]


def test_catalogue_ids_are_the_same_either_way(spark):
    kind = spark.createDataFrame([], schemas.CATALOGUE)
    cols = [c for c in merge.CATALOGUE_COLUMNS]
    incoming = spark.createDataFrame([(f"/{i}",) for i in (3, 1, 2)], "file_path string").select(
        *[F.col(c) if c == "file_path" else F.lit(None).cast(kind.schema[c].dataType).alias(c) for c in cols])
    first = merge.merge_catalogue(kind, incoming.where("file_path = '/2'"), TS)
    a = merge.merge_catalogue(first, incoming, TS).select("id", "file_path").orderBy("id").collect()
    b = merge.merge_catalogue(first, merge.number_inserts(first, incoming), TS, assign_ids=False).select("id", "file_path").orderBy("id").collect()
    assert a == b and [r.file_path for r in a] == ["/2", "/1", "/3"]


def test_the_longest_root_wins(spark):
    roots = [("int", "/srv/images/"), ("deep", "/srv/images/a/b"), ("zwin", "/srv/images/a/b"), ("usb", "/mnt"), (None, "/srv"), ("x", None)]
    rng = random.Random(3)
    paths = [None, "", "plain", "/top.jpg", "/srv/images/x.jpg", "/srv/images2/x.jpg", "/srv/images/a/b", "/srv/images/a/b/c.jpg", "/srv/images/a/bc/d.jpg", "/srv/images/a/b/..odd/e\\f.jpg", "/mnt/" + "d/" * 200 + "x.jpg"]
    paths += ["/" + "/".join(rng.choice(["srv", "images", "a", "b", "mnt"]) for _ in range(rng.randrange(1, 7))) for _ in range(80)]
    paths += ["/srv/images/hot/same.jpg"] * 40
    listing = spark.createDataFrame([(i, p, "kept", 1) for i, p in enumerate(paths)], "n int, file_path string, root_name string, _dir2 int")
    got = {r.n: (r.root_tag, r.root) for r in tag_by_root(listing, spark.createDataFrame(roots, "source_type string, root string")).collect()}
    assert len(got) == len(paths)
    known = [("int", "/srv/images"), ("deep", "/srv/images/a/b"), ("usb", "/mnt")]
    for i, p in enumerate(paths):
        hits = [(len(r), t, r) for t, r in known if p is not None and p.startswith(r + "/")]
        assert got[i] == (max(hits)[1:] if hits else (None, None)), p
    keys = {r.file_path: r.s3_key for r in tag_by_root(listing, spark.createDataFrame(roots, "source_type string, root string")).collect()}
    assert keys["/srv/images/a/b/c.jpg"] == "deep/c.jpg" and keys["/srv/images/a/b"] == "int/a/b" and keys["/top.jpg"] is None
    whole = tag_by_root(listing, spark.createDataFrame([("all", "/")], "source_type string, root string")).where("file_path = '/top.jpg'").first()
    assert (whole.root_tag, whole.root, whole.s3_key) == ("all", "/", "all/top.jpg")
    assert tag_by_root(listing.limit(0), spark.createDataFrame(roots, "source_type string, root string")).count() == 0
