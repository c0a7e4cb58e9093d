"""EXIF expressions against Python's own semantics on the FIXTURES A9 rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from darkroom.functions.exif import clean_text, first_truthy, parse_exif_date
from darkroom.operators.metadata import exif_fields, exif_keys, exif_report

DATE_CASES = [
    "2024:01:02 03:04:05",
    "0000:00:00 00:00:00",
    "2024:01:02 03:04:05+02:00",
    "2024:1:2 3:4:5",
    "2024:03:10 02:30:00",
    "2024:02:30 00:00:00",
    "2024:02:03 04:05:60",
    "2024:01:02  03:04:05",
    " 2024:01:02 03:04:05",
    "2024:01: 7 03:04:05",
    "2024:01:02 03:04:05\n",
    "2024:01:02\t03:04:05",
    "20240102 030405",
    "",
]


def py_parse(text):
    try:
        return dt.datetime.strptime(text, "%Y:%m:%d %H:%M:%S")
    except (ValueError, TypeError):
        return None


def test_parse_exif_date_matches_strptime(spark):
    df = spark.createDataFrame([(t,) for t in DATE_CASES], "t string")
    got = {r.t: r.d for r in df.select("t", parse_exif_date("t").alias("d")).collect()}
    for t in DATE_CASES:
        assert got[t] == py_parse(t), t


CHAIN_RECORDS = [
    {"ISO": 0, "ISOValue": 64},
    {"ISO": 0},
    {"ISO": "0", "ISOValue": 64},
    {"ISO": False, "ISOValue": 64},
    {"ISO": 0.0, "ISOValue": 64},
    {"ISO": [], "ISOValue": 64},
    {"ISO": {}, "ISOValue": 64},
    {"ISO": None, "ISOValue": 64},
    {"ISO": 0, "ISOValue": 0},
    {"ISO": 200},
    {"ISO": "", "ISOValue": ""},
    {"ISOValue": 100},
    {},
]


def py_text(v):
    # Values the scripts store: str(v).strip() or None (numbers keep JSON spelling here).
    if v is None:
        return None
    s = v if isinstance(v, str) else json.dumps(v)
    return s.strip() or None


def test_first_truthy_matches_python_or(spark):
    rows = [(json.dumps(r),) for r in CHAIN_RECORDS]
    df = spark.createDataFrame(rows, "j string")
    got = [r.v for r in df.select(clean_text(first_truthy("j", ("ISO", "ISOValue"))).alias("v")).collect()]
    for rec, g in zip(CHAIN_RECORDS, got):
        assert g == py_text(rec.get("ISO") or rec.get("ISOValue")), rec


def _records(spark, recs):
    return spark.createDataFrame([(f"/p/{i}.JPG", json.dumps(r)) for i, r in enumerate(recs)], "file_path string, metadata_json string")


def test_exif_fields_chains(spark):
    recs = [
        {"Lens": "", "LensModel": "XF23mm", "Make": "  ", "Model": " X-T4 ", "FNumber": 0, "ApertureValue": 0},
        {"DateTimeOriginal": "bad", "CreateDate": "2024:01:02 03:04:05", "ShutterSpeed": "1/250", "FocalLength": 23.0},
        {"DateTimeOriginal": "", "CreateDate": "2024:01:02 03:04:05", "ExposureTime": 0.004, "FNumber": 2.8},
        {"LensID": "L1", "ISOValue": 64, "ISO": 0, "ShutterSpeedValue": "1/60"},
    ]
    out = {r.file_path: r for r in exif_fields(_records(spark, recs)).collect()}
    a, b, c, d = (out[f"/p/{i}.JPG"] for i in range(4))
    assert a.lens == "XF23mm" and a.camera_make is None and a.camera_model == "X-T4" and a.aperture == "0"
    # The chosen date text is parsed; a bad DateTimeOriginal hides a good CreateDate.
    assert b.date_taken is None and b.shutter_speed == "1/250" and b.focal_length == "23.0"
    assert c.date_taken == dt.datetime(2024, 1, 2, 3, 4, 5) and c.shutter_speed == "0.004" and c.aperture == "2.8"
    assert d.lens == "L1" and d.iso == "64" and d.shutter_speed == "1/60" and d.date_taken is None
    assert a.metadata_json == json.dumps(recs[0])


def test_exif_fields_token_edges(spark):
    # Python `or` on the member values: key case matters, a JSON null and the
    # number 0 are falsy, the string "0" and a non-empty list are truthy.
    recs = [
        {"lens": "lower", "Lens": None, "LensModel": "M1"},
        {"ISO": "0", "ISOValue": 64},
        {"ISO": 0.0, "ISOValue": 64, "FNumber": [1], "ApertureValue": 2},
        {"ShutterSpeed": {}, "ExposureTime": False, "ShutterSpeedValue": 0},
    ]
    out = {r.file_path: r for r in exif_fields(_records(spark, recs)).collect()}
    a, b, c, d = (out[f"/p/{i}.JPG"] for i in range(4))
    assert a.lens == "M1"
    assert b.iso == "0" and c.iso == "64"
    assert c.aperture == "[1]"
    assert d.shutter_speed == "0"


def test_exif_keys_sorted(spark):
    recs = [{"b": 1, "a": "x", "C": None}]
    rows = exif_keys(_records(spark, recs)).orderBy("key_no").collect()
    assert [(r.key_no, r.key, r.value) for r in rows] == [(1, "C", None), (2, "a", "x"), (3, "b", "1")]


def test_exif_report_key_presence(spark):
    recs = [{"DateTimeOriginal": "", "CreateDate": "x", "Make": "Canon", "ISOValue": 100, "ImageWidth": 6000}]
    r = exif_report(_records(spark, recs)).collect()[0]
    assert r.date_taken == ""  # present, empty: kept
    assert r.camera == "Canon N/A"
    assert r.iso == "100"
    assert r.dimensions == "6000 x N/A"
    assert r.lens == "N/A"


@pytest.mark.parametrize("value,expected", [("  a b ", "a b"), ("\t\n", None), ("", None), (None, None), ("　x\xa0", "x")])
def test_clean_text(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(clean_text(F.col("v")).alias("c")).first().c == expected


def test_fixture_text_ignores_session_time_zone(spark):
    from darkroom.sources.fixtures import _f

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        q = f"SELECT {_f('spark', 'exifts', 'ts')} AS e, {_f('spark', 'hour', 'ts')} AS h FROM (SELECT timestamp_ntz'2024-03-10 02:30:05' AS ts)"
        r = spark.sql(q).first()
        assert (r.e, r.h) == ("2024:03:10 02:30:05", "2024-03-10T02:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
