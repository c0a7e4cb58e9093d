"""Upserts: the scripts' ON CONFLICT rules, restated row by row."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from darkroom.operators.merge import add_missing_columns, check_keys, merge_catalogue, merge_ledger

CAT = ("id long, file_path string, date_taken timestamp_ntz, camera_make string, camera_model string, lens string, "
       "shutter_speed string, iso string, aperture string, focal_length string, metadata_json string, created_at timestamp_ntz")
NEW = ("file_path string, date_taken timestamp_ntz, camera_make string, camera_model string, lens string, "
       "shutter_speed string, iso string, aperture string, focal_length string, metadata_json string")
D1, D2, C0 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2023, 12, 1)


def _old(spark):
    return spark.createDataFrame([
        (1, "/complete", D1, "Canon", "R5", None, None, "100", None, None, "{}", C0),
        (2, "/no_date", None, "Canon", None, "L1", None, None, None, None, "{}", C0),
        (3, "/no_json", D1, None, "X", None, None, None, None, None, None, C0),
        (4, "/untouched", None, None, None, None, None, None, None, None, None, C0),
    ], CAT)


def _new(spark):
    return spark.createDataFrame([
        ("/complete", D2, "Nikon", "Z9", "Lx", "1/8", "200", "2.8", "50", '{"a":1}'),
        ("/no_date", D2, None, "R6", None, "1/60", None, None, None, '{"b":2}'),
        ("/no_json", None, "Fuji", None, None, None, None, None, None, '{"c":3}'),
        ("/fresh", D1, "Sony", None, None, None, None, None, None, '{"d":4}'),
    ], NEW)


def test_merge_catalogue_rules(spark):
    out = {r.file_path: r for r in merge_catalogue(_old(spark), _new(spark), "2024-02-01 00:00:00").collect()}
    assert out["/complete"].camera_make == "Canon" and out["/complete"].date_taken == D1  # complete: untouched
    nd = out["/no_date"]
    assert (nd.date_taken, nd.camera_make, nd.camera_model, nd.lens, nd.shutter_speed) == (D2, "Canon", "R6", "L1", "1/60")
    assert nd.metadata_json == '{"b":2}' and nd.id == 2 and nd.created_at == C0
    nj = out["/no_json"]
    assert (nj.date_taken, nj.camera_make, nj.camera_model, nj.metadata_json) == (D1, "Fuji", "X", '{"c":3}')
    assert out["/untouched"].id == 4
    fresh = out["/fresh"]
    assert fresh.id == 5 and fresh.created_at == dt.datetime(2024, 2, 1) and fresh.camera_make == "Sony"


def test_merge_catalogue_idempotent(spark):
    once = merge_catalogue(_old(spark), _new(spark), "2024-02-01 00:00:00")
    twice = merge_catalogue(once, _new(spark), "2024-02-01 00:00:00")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_check_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "file_path string, v int")
    acc, rej = check_keys(df)
    assert [r.v for r in acc.collect()] == [3]
    assert sorted((r.v, r.reason) for r in rej.collect()) == [(1, "duplicate_key"), (2, "duplicate_key"), (4, "null_key")]


LEDGER = ("id long, file_path string, s3_key string, source_type string, file_size long, uploaded_at timestamp_ntz, "
          "last_verified_at timestamp_ntz, md5_checksum string, status string")
RES = "file_path string, s3_key string, source_type string, file_size long, md5_checksum string, status string"


def test_merge_ledger_rules(spark):
    old = spark.createDataFrame([
        (1, "/a", "internal/a", "internal", 10, D1, None, "m1", "uploaded"),
        (2, "/b", "internal/b", "internal", 20, D1, None, "m2", "error"),
        (3, "/c", "internal/c", "internal", 30, D1, None, "m3", "uploaded"),
    ], LEDGER)
    res = spark.createDataFrame([
        ("/b", "external/b", "external", 21, "m2x", "uploaded"),   # success on an existing row
        ("/c", "external/c", "external", None, None, "error"),     # failure on an existing row
        ("/d", "internal/d", "internal", 40, "m4", "uploaded"),    # new success
        ("/e", "internal/e", "internal", None, None, "error"),     # new failure
    ], RES)
    run = dt.datetime(2024, 2, 1)
    out = {r.file_path: r for r in merge_ledger(old, res, "2024-02-01 00:00:00").collect()}
    assert tuple(out["/a"])[1:] == ("/a", "internal/a", "internal", 10, D1, None, "m1", "uploaded")
    b = out["/b"]
    assert (b.s3_key, b.source_type, b.file_size, b.md5_checksum, b.status, b.uploaded_at) == (
        "external/b", "internal", 21, "m2x", "uploaded", run)
    c = out["/c"]
    assert (c.s3_key, c.file_size, c.md5_checksum, c.status, c.uploaded_at) == ("internal/c", 30, "m3", "error", D1)
    assert (out["/d"].status, out["/d"].uploaded_at, out["/d"].id) == ("uploaded", run, 4)
    e = out["/e"]
    assert (e.status, e.file_size, e.md5_checksum, e.uploaded_at, e.s3_key) == ("error", None, None, run, "internal/e")


def test_add_missing_columns(spark):
    df = spark.createDataFrame([("/a",)], "file_path string")
    schema = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("s3_full_path", T.StringType())])
    out = add_missing_columns(df, schema)
    assert out.columns == ["file_path", "s3_full_path"] and out.first().s3_full_path is None
