"""Listing in rounds and the manifest of landed files, on temporary folders."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from darkroom import schemas
from darkroom.plans import jobs
from darkroom.plans.snapshots import latest_version, read_version
from darkroom.sources import frontier
from darkroom.sources.frontier import list_entries, list_tree, with_attributes
from darkroom.sources.landed import landed_records
from darkroom.sources.media_files import list_media


def _write(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def _tree():
    base = tempfile.mkdtemp(prefix="darkroom-tree-")
    for name in ("a.jpg", "_b.NEF", ".c.jpg", "2024/01/02/d.jpg", "2024/01/03/e.TXT", "2024/profiles/f.jpg", "x/y/z/g.jpg"):
        _write(f"{base}/{name}", name.encode())
    os.symlink(f"{base}/a.jpg", f"{base}/link.jpg")
    os.symlink(f"{base}/missing.jpg", f"{base}/dangling.jpg")
    os.symlink(f"{base}/2024", f"{base}/linked")
    os.makedirs(f"{base}/empty")
    return base


def test_tree_equals_the_walk(spark):
    base = _tree()
    roots = {"internal": base, "external": f"{base}-missing", "inner": f"{base}/2024/"}
    for links in (True, False):
        for exclude in ((), ("profiles",)):
            want = list_media(spark, roots, exclude=exclude, links=links)
            got = list_tree(spark, roots, exclude, links).select(*want.columns)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    some = {os.path.basename(r.file_path) for r in list_tree(spark, [base], suffixes=(".nef", ".txt")).collect()}
    assert some == {"_b.NEF", "e.TXT"}
    flat = {os.path.basename(r.file_path) for r in list_tree(spark, [base], recursive=False, links=False).collect()}
    assert flat == {"a.jpg", "_b.NEF", ".c.jpg"}
    assert list_tree(spark, [f"{base}-missing"]).collect() == [] and list_tree(spark, []).collect() == []


def test_flat_root_and_one_year_tree_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(frontier, "BATCH", 7)
    base = tempfile.mkdtemp(prefix="darkroom-flat-")
    for i in range(200):
        _write(f"{base}/flat/f{i:03d}.jpg")
    for day in range(1, 29):
        _write(f"{base}/tree/2024/01/{day:02d}/a.jpg")
    for root in ("flat", "tree"):
        files = with_attributes(list_entries(spark, [f"{base}/{root}"]))
        tasks = files.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) >= 6 and sum(r["count"] for r in tasks) == (200 if root == "flat" else 28)
    days = frontier.spread(list_entries(spark, [f"{base}/tree/2024/01"]).where("folder"), "path")
    assert days.select(F.spark_partition_id()).distinct().count() >= 6


def test_a_folder_that_cannot_be_read_is_an_error(spark):
    folders = spark.createDataFrame([("/r", f"{tempfile.mkdtemp()}/gone")], "root string, path string")
    with pytest.raises(Exception, match="FileNotFoundError"):
        frontier.read_folders(folders).collect()


def _landed(base, i, value, at):
    path = f"{base}/exif/r{i}.json"
    _write(path, value if isinstance(value, bytes) else json.dumps([value]).encode())
    os.utime(path, (at, at))


def test_landed_files_are_opened_once(spark):
    base = tempfile.mkdtemp(prefix="darkroom-landed-")
    for i in range(6):
        _landed(base, i, {"SourceFile": f"/p/{i}.JPG", "Make": "A"}, 1000 + i)
    _landed(base, 6, b"[]", 1006)
    _landed(base, 7, {"Make": "no name"}, 1007)
    _landed(base, 8, b"[{ }]", 1008)
    _write(f"{base}/exif/_hidden.json", b"[1]")
    read = lambda: landed_records(spark, f"{base}/exif", f"{base}/manifest")
    records, rejects, opened = read()
    assert opened == 9
    assert {r.file_path for r in records.collect()} == {f"/p/{i}.JPG" for i in range(6)} | {f"file://{base}/exif/r7.json"}
    assert {r.landed_path for r in rejects.collect()} == {f"file://{base}/exif/r{i}.json" for i in (6, 8)}
    assert read()[2] == 0
    # A known file is not opened again: other bytes of equal time and size stay unseen.
    size = os.path.getsize(f"{base}/exif/r0.json")
    _landed(base, 0, b"?" * size, 1000)
    _landed(base, 1, {"SourceFile": "/p/1.JPG", "Make": "B"}, 2000)  # rewritten
    _landed(base, 9, {"SourceFile": "/p/9.JPG"}, 2001)  # new
    os.remove(f"{base}/exif/r2.json")
    records, rejects, opened = read()
    assert opened == 2
    got = {r.file_path: json.loads(r.metadata_json).get("Make") for r in records.collect()}
    assert got == {"/p/0.JPG": "A", "/p/1.JPG": "B", "/p/3.JPG": "A", "/p/4.JPG": "A", "/p/5.JPG": "A", "/p/9.JPG": None,
                   f"file://{base}/exif/r7.json": "no name"}
    assert records.count() == len(got) and rejects.count() == 2


def test_catalogue_job_opens_only_new_landed_files(spark):
    base = tempfile.mkdtemp(prefix="darkroom-landed-job-")
    for i in range(4):
        _write(f"{base}/images/{i}.JPG")
        if i < 3:
            _landed(base, i, {"SourceFile": f"{base}/images/{i}.JPG", "CreateDate": "2024:01:02 03:04:05"}, 1000 + i)
    run = lambda day: jobs.run_catalogue(spark, f"{base}/images", f"{base}/exif", f"{base}/cat", None, f"2024-02-0{day} 00:00:00")
    assert run(1) == {"processed": 3, "opened": 3}
    _landed(base, 3, {"SourceFile": f"{base}/images/3.JPG", "CreateDate": "2024:01:02 03:04:05"}, 1003)
    assert run(2) == {"processed": 1, "opened": 1}
    assert read_version(spark, f"{base}/cat", latest_version(spark, f"{base}/cat"), schemas.CATALOGUE).count() == 4


def test_dcim_folder_of_the_card_itself(spark):
    base = tempfile.mkdtemp(prefix="darkroom-dcim-")
    vols = spark.createDataFrame([("internal", f"{base}/lib", True, "100"), ("external", f"{base}/ext", True, "100")],
                                 "volume string, path string, exists boolean, free_gb string")
    os.makedirs(f"{base}/lib")
    _write(f"{base}/DCIM/card/a.jpg")
    _write(f"{base}/DCIM/card/dcim/b.jpg")
    _write(f"{base}/plain/c.jpg")
    os.makedirs(f"{base}/plain/DCIM")
    names = lambda card: sorted(r.file_name for r in jobs.plan_card_import(spark, card, vols, "2024/02/01").collect())
    assert names(f"{base}/DCIM/card") == ["b.jpg"]  # a DCIM above the card does not count
    assert names(f"{base}/plain") == []  # an empty DCIM is the folder to search
    assert names(f"{base}/DCIM") == ["a.jpg", "b.jpg"]
