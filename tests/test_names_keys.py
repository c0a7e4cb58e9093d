"""Path, name and key expressions against the scripts' Python/shell rules."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from darkroom.functions.keys import date_dir, object_tags, root_of, storage_key, tag_text
from darkroom.functions.names import (
    base_name,
    has_excluded_component,
    is_image_any_case,
    is_image_exact_case,
    is_jpeg,
    path_suffix,
    stem,
)

NAMES = ["a.JPG", "a.b.JPG", ".jpg", ".h.JPG", "a.", "noext", "x.Jpg", "y.jpeg", "z.txt", "IMG[1].jpg", "a b#%20.NEF"]


def py_stem(n):
    return n.rsplit(".", 1)[0] if "." in n else n


def test_stem_suffix_jpeg(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    rows = df.select("n", stem("n").alias("s"), path_suffix("n").alias("x"), is_jpeg("n").alias("j")).collect()
    for r in rows:
        assert r.s == py_stem(r.n), r.n
        assert r.x == Path(r.n).suffix, r.n
        assert r.j == (r.n.lower().endswith(".jpg") or r.n.lower().endswith(".jpeg")), r.n


def test_listing_rules(spark):
    exts = {".jpg", ".jpeg", ".raw", ".cr2", ".nef", ".arw", ".dng", ".tif", ".tiff", ".png", ".raf"}
    paths = [
        "/r/a.jpg", "/r/a.JPG", "/r/a.Jpg", "/r/a.txt", "/r/noext", "/r/_DSC1.JPG", "/r/.h.JPG", "/r/_sub/b.JPG",
        "/r/a b.JPG", "/r/#x.png", "/r/%20.raf", "/r/thumbs/a.jpg", "/r/profile/a.jpg", "/r/profiles/a.jpg",
        "/r/library/a.jpg", "/r/.jpg", "/r/mythumbs/a.jpg",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    excl = ("library", "thumbs", "encoded-video", "profiles", "backups")
    rows = df.select(
        "p",
        is_image_any_case(base_name("p")).alias("any"),
        is_image_exact_case(base_name("p")).alias("exact"),
        has_excluded_component("p", excl).alias("ex"),
    ).collect()
    for r in rows:
        name = os.path.basename(r.p)
        assert r.any == (Path(name).suffix.lower() in exts), r.p
        assert r.exact == any(name.endswith(e) or name.endswith(e.upper()) for e in exts), r.p
        assert r.ex == any(e in Path(r.p).parts for e in excl), r.p


def py_key(path, source_type, root):
    rel = os.path.relpath(path, root)
    if rel.startswith(".."):
        rel = Path(path).name
    return f"{source_type}/{rel.replace(chr(92), '/')}"


def test_storage_key(spark):
    roots = {"internal": "/srv/images", "external": "/mnt/ext/images"}
    cases = [
        ("/srv/images/2024/a.jpg", "internal"),
        ("/srv/other/a.jpg", "internal"),
        ("/srv/images/dir\\x/a.jpg", "internal"),
        ("/srv/images/..hidden/a.jpg", "internal"),
        ("/mnt/ext/images/a.JPG", "external"),
        ("/srv/images2/a.jpg", "internal"),
    ]
    df = spark.createDataFrame(cases, "p string, s string")
    got = df.select(storage_key("p", "s", root_of("s", roots)).alias("k")).collect()
    for (p, s), r in zip(cases, got):
        assert r.k == py_key(p, s, roots[s]), p


def test_date_dir(spark):
    cases = {"IMG_20240131_1.jpg": "2024/01/31", "DSC_12345678.jpg": "1234/56/78", "DSCF0001.RAF": "2024/02/01",
             "a1234567b20240101.jpg": "2024/01/01"}
    df = spark.createDataFrame([(n,) for n in cases], "n string")
    for r in df.select("n", date_dir("n", "2024/02/01").alias("d")).collect():
        assert r.d == cases[r.n]


def test_date_dir_validated(spark):
    cases = {"IMG_20240229_1.jpg": "2024/02/29", "IMG_20230229_1.jpg": "2024/02/01", "DSC_12345678.jpg": "2024/02/01",
             "X_00000101.jpg": "2024/02/01", "DSCF0001.RAF": "2024/02/01"}
    df = spark.createDataFrame([(n,) for n in cases], "n string")
    for r in df.select("n", date_dir("n", "2024/02/01", validate=True).alias("d")).collect():
        assert r.d == cases[r.n], r.n


def test_tag_text(spark):
    df = spark.createDataFrame([("internal", 12, "/srv/images/a b&c.jpg")], "s string, size long, p string")
    t = df.select(tag_text(object_tags("s", "2024-02-01T00:00:00", "size", "p")).alias("t")).first().t
    assert t == "source_type=internal&upload_date=2024-02-01T00:00:00&file_size=12&original_path=/srv/images/a b&c.jpg"
