"""End-to-end jobs and incremental streaming runs on temporary folders."""

import hashlib
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from darkroom import schemas
from darkroom.operators import metadata
from darkroom.plans import jobs
from darkroom.plans.snapshots import commits, latest_version, read_all, read_version, version_path, write_version
from darkroom.sources.media_files import MediaFilesReader
from darkroom.streaming.incremental import stream_catalogue, stream_stacks


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_catalogue_job_twice(spark):
    base = tempfile.mkdtemp(prefix="darkroom-job-")
    images, exif, cat = f"{base}/images", f"{base}/exif", f"{base}/catalogue"
    for i, name in enumerate(["a.JPG", "b.JPG", "_c.JPG", "thumbs/d.JPG"]):
        _write(f"{images}/{name}", b"x" * (i + 1))
    recs = {
        "a.JPG": {"DateTimeOriginal": "2024:01:02 03:04:05", "Make": "FUJIFILM"},
        "b.JPG": {"DateTimeOriginal": "", "CreateDate": "", "Make": "Canon"},  # no date: retried later
        "_c.JPG": {"CreateDate": "2024:02:03 04:05:06"},
    }
    for i, (name, rec) in enumerate(recs.items()):
        rec = dict(rec, SourceFile=f"{images}/{name}")
        _write(f"{exif}/r{i}.json", json.dumps([rec]).encode())
    _write(f"{exif}/bad.json", b"[]")
    first = jobs.run_catalogue(spark, images, exif, cat, 1, "2024-02-01 00:00:00")
    assert first["processed"] == 3
    rej = spark.read.parquet(version_path(spark, f"{cat}_rejects", 1)).collect()
    assert [(os.path.basename(r.file_path), r.reason) for r in rej] == [("bad.json", "unreadable")]
    second = jobs.run_catalogue(spark, images, exif, cat, 2, "2024-02-02 00:00:00")
    assert second["processed"] == 1  # only the undated row is extracted again
    v2 = read_version(spark, cat, 2, schemas.CATALOGUE).orderBy("file_path").collect()
    assert [os.path.basename(r.file_path) for r in v2] == ["_c.JPG", "a.JPG", "b.JPG"]
    assert sorted(r.id for r in v2) == [1, 2, 3]
    assert latest_version(spark, cat) == 2


def test_catalogue_job_limit_rounds_up_to_a_batch(spark):
    base = tempfile.mkdtemp(prefix="darkroom-job-limit-")
    images, exif, cat = f"{base}/images", f"{base}/exif", f"{base}/catalogue"
    names = ["a.JPG", "b.JPG", "_c.JPG"]
    for i, name in enumerate(names):
        _write(f"{images}/{name}", b"x")
        _write(f"{exif}/r{i}.json", json.dumps([{"SourceFile": f"{images}/{name}", "CreateDate": "2024:01:02 03:04:05"}]).encode())
    out = jobs.run_catalogue(spark, images, exif, cat, 1, "2024-02-01 00:00:00", limit=1, batch_size=2)
    assert out["processed"] == 2  # the limit is checked after a whole batch
    rows = read_version(spark, cat, 1, schemas.CATALOGUE).collect()
    assert sorted(os.path.basename(r.file_path) for r in rows) == ["_c.JPG", "a.JPG"]  # path order


def test_backup_jobs(spark):
    base = tempfile.mkdtemp(prefix="darkroom-bk-")
    roots = {"internal": f"{base}/int", "external": f"{base}/ext"}
    _write(f"{base}/int/a.jpg", b"aaa")
    _write(f"{base}/int/_b.NEF", b"bb")
    _write(f"{base}/int/thumbs/t.jpg", b"t")
    _write(f"{base}/ext/c.png", b"c")
    ledger, audit = f"{base}/ledger", f"{base}/audit"
    plan = jobs.plan_backup(spark, roots, ledger, "bkt", "2024-02-01 00:00:00")
    rows = {r.s3_key: r for r in plan.collect()}
    assert set(rows) == {"internal/a.jpg", "internal/_b.NEF", "external/c.png"}
    assert rows["internal/a.jpg"].md5_checksum == hashlib.md5(b"aaa").hexdigest()
    results = plan.select("file_path", "s3_key", "source_type", "file_size", "md5_checksum", F.lit("uploaded").alias("status"))
    jobs.record_uploads(spark, ledger, results, 1, "2024-02-01 00:00:00")
    assert jobs.plan_backup(spark, roots, ledger, "bkt", "2024-02-02 00:00:00").count() == 0
    os.remove(f"{base}/int/a.jpg")
    deleted = jobs.sync_deletions(spark, roots, ledger, audit, 2, "bkt", "2024-02-03 00:00:00").collect()
    assert [r.s3_full_path for r in deleted] == ["s3://bkt/internal/a.jpg"]
    v2 = read_version(spark, ledger, 2, schemas.LEDGER)
    assert sorted(r.s3_key for r in v2.collect()) == ["external/c.png", "internal/_b.NEF"]
    assert read_all(spark, audit, schemas.AUDIT).count() == 1
    jobs.sync_deletions(spark, roots, ledger, audit, 2, "bkt", "2024-02-03 00:00:00")  # retried run
    assert read_all(spark, audit, schemas.AUDIT).count() == 1


def test_card_import_plan(spark):
    base = tempfile.mkdtemp(prefix="darkroom-card-")
    _write(f"{base}/card/DCIM/100/IMG_20240131_1.jpg", b"1")
    _write(f"{base}/card/DCIM/100/OLD.JPG", b"2")
    _write(f"{base}/lib/2020/01/01/OLD.JPG", b"2")
    vols = spark.createDataFrame(
        [("internal", f"{base}/lib", True, "500"), ("external", f"{base}/ext", True, "900")],
        "volume string, path string, exists boolean, free_gb string",
    )
    plan = {os.path.basename(r.file_path): r for r in jobs.plan_card_import(spark, f"{base}/card", vols, "2024/02/01").collect()}
    assert plan["IMG_20240131_1.jpg"].dest_path == f"{base}/lib/2024/01/31/IMG_20240131_1.jpg"
    assert plan["OLD.JPG"].action == "skip"


def test_stream_catalogue_available_now(spark):
    base = tempfile.mkdtemp(prefix="darkroom-stream-")
    land, cat, ckpt = f"{base}/land", f"{base}/cat", f"{base}/ckpt"
    _write(f"{land}/r1.json", json.dumps([{"SourceFile": "/i/a.JPG", "CreateDate": "2024:01:02 03:04:05"}]).encode())
    stream_catalogue(spark, land, cat, ckpt, "2024-02-01 00:00:00")
    assert latest_version(spark, cat) == 1
    _write(f"{land}/r2.json", json.dumps([{"SourceFile": "/i/b.JPG", "Make": "Canon"}]).encode())
    stream_catalogue(spark, land, cat, ckpt, "2024-02-02 00:00:00")
    v = latest_version(spark, cat)
    rows = read_version(spark, cat, v, schemas.CATALOGUE).collect()
    assert sorted(r.file_path for r in rows) == ["/i/a.JPG", "/i/b.JPG"]
    stream_catalogue(spark, land, cat, ckpt, "2024-02-03 00:00:00")  # nothing new
    assert latest_version(spark, cat) == v


def test_stream_stacks_late_partner(spark):
    base = tempfile.mkdtemp(prefix="darkroom-sstack-")
    land, state, plans, ckpt = f"{base}/land", f"{base}/state", f"{base}/plans", f"{base}/ckpt"

    def page(name, items):
        _write(f"{land}/{name}.json", json.dumps({"assets": {"items": items, "nextPage": None}}).encode())

    page("p1", [{"id": "j1", "originalFileName": "A.JPG", "localDateTime": "t"},
                {"id": "r9", "originalFileName": "Z.RAF", "localDateTime": "t"}])
    stream_stacks(spark, land, state, plans, ckpt)
    v1 = latest_version(spark, plans)
    assert spark.read.parquet(version_path(spark, plans, v1)).count() == 0  # no pair yet
    page("p2", [{"id": "r1", "originalFileName": "A.RAF", "localDateTime": "t"}])  # late partner
    stream_stacks(spark, land, state, plans, ckpt)
    v2 = latest_version(spark, plans)
    req = spark.read.parquet(version_path(spark, plans, v2)).collect()
    assert [(r.base_name, r.parent_id, r.asset_ids) for r in req] == [("A", "j1", "j1,r1")]
    st = {r.asset_id: r.stack_count for r in read_version(spark, state, latest_version(spark, state), schemas.ASSETS).collect()}
    assert st == {"j1": 2, "r1": 2, "r9": None}
    # A run with nothing new lands no batch: no new plan or state version.
    stream_stacks(spark, land, state, plans, ckpt)
    assert latest_version(spark, plans) == v2 and latest_version(spark, state) == v2


def test_cli_stack_and_libraries(spark, capsys):
    from darkroom import cli

    base = tempfile.mkdtemp(prefix="darkroom-cli-")
    _write(f"{base}/pages/p.json", json.dumps({"assets": {"items": [
        {"id": "a", "originalFileName": "X.JPG", "localDateTime": "t"},
        {"id": "b", "originalFileName": "X.RAF", "localDateTime": "t"}], "nextPage": None}}).encode())
    assert cli.main(["stack", "--pages", f"{base}/pages", "--plan-out", f"{base}/plan"]) == 0
    assert [r.asset_ids for r in spark.read.parquet(f"{base}/plan").collect()] == ["a,b"]
    _write(f"{base}/libs/l.json", json.dumps([{"id": "1", "type": "EXTERNAL"}, {"id": "2"}]).encode())
    assert cli.main(["libraries", "--libraries", f"{base}/libs", "--external-only"]) == 0
    out = capsys.readouterr().out
    assert "EXTERNAL" in out and "UPLOAD" not in out


def test_undated_photo_is_completed_by_a_later_record(spark):
    base = tempfile.mkdtemp(prefix="darkroom-job-retry-")
    images, exif, cat = f"{base}/images", f"{base}/exif", f"{base}/catalogue"
    _write(f"{images}/a.JPG", b"x")
    path = f"{images}/a.JPG"
    _write(f"{exif}/r0.json", json.dumps([{"SourceFile": path, "Make": "Canon"}]).encode())
    jobs.run_catalogue(spark, images, exif, cat, 1, "2024-02-01 00:00:00")
    _write(f"{exif}/r1.json", json.dumps([{"SourceFile": path, "CreateDate": "2024:01:02 03:04:05"}]).encode())
    assert jobs.run_catalogue(spark, images, exif, cat, 2, "2024-02-02 00:00:00")["processed"] == 1
    row = read_version(spark, cat, 2, schemas.CATALOGUE).first()
    assert row.date_taken is not None and row.camera_make == "Canon"


def test_limit_counts_files_that_have_a_record(spark):
    base = tempfile.mkdtemp(prefix="darkroom-job-late-")
    images, exif, cat = f"{base}/images", f"{base}/exif", f"{base}/catalogue"
    for name in "abcd":
        _write(f"{images}/{name}.JPG", b"x")
    for name in "cd":
        _write(f"{exif}/{name}.json", json.dumps([{"SourceFile": f"{images}/{name}.JPG", "CreateDate": "2024:01:02 03:04:05"}]).encode())
    assert jobs.run_catalogue(spark, images, exif, cat, 1, "2024-02-01 00:00:00", limit=2, batch_size=2)["processed"] == 2


def test_unreadable_log_is_an_error_and_a_dead_write_changes_nothing(spark):
    base = tempfile.mkdtemp(prefix="darkroom-snap-") + "/t"
    one = spark.createDataFrame([(1,)], "a int")
    write_version(one, base, 1)
    with pytest.raises(Exception):
        write_version(spark.createDataFrame([("x",)], "a string").select(F.col("a").cast("int")), base, 2)  # ANSI cast fails
    assert latest_version(spark, base) == 1
    assert read_version(spark, base, 1, one.schema).collect() == one.collect()
    assert commits(spark, base + "-none") is None
    log = next(f"{d}/{n}" for d, _, names in os.walk(f"{base}/_versions") for n in names if n.startswith("part-"))
    with open(log, "wb") as fh:
        fh.write(b"no parquet")
    with pytest.raises(Exception):
        latest_version(spark, base)


def test_batch_and_stream_share_one_sequence(spark):
    base = tempfile.mkdtemp(prefix="darkroom-mix-")
    images, exif, land, cat = f"{base}/images", f"{base}/exif", f"{base}/land", f"{base}/cat"
    _write(f"{images}/a.JPG", b"x")
    _write(f"{exif}/a.json", json.dumps([{"SourceFile": f"{images}/a.JPG", "CreateDate": "2024:01:02 03:04:05"}]).encode())
    jobs.run_catalogue(spark, images, exif, cat, 1, "2024-02-01 00:00:00")
    jobs.run_catalogue(spark, images, exif, cat, 2, "2024-02-01 00:00:00")
    _write(f"{land}/b.json", json.dumps([{"SourceFile": "/i/b.JPG", "CreateDate": "2024:01:02 03:04:05"}]).encode())
    stream_catalogue(spark, land, cat, f"{base}/ckpt", "2024-02-02 00:00:00")
    assert latest_version(spark, cat) == 3
    rows = read_version(spark, cat, 3, schemas.CATALOGUE).collect()
    assert sorted(os.path.basename(r.file_path) for r in rows) == ["a.JPG", "b.JPG"]


def test_results_of_one_path_are_resolved(spark):
    base = tempfile.mkdtemp(prefix="darkroom-results-")
    kind = "file_path string, s3_key string, source_type string, file_size long, md5_checksum string, status string, seq int"
    rows = [("/a", "k", "internal", 1, "m", "error", 1), ("/a", "k", "internal", 1, "m", "uploaded", 2),
            ("/b", "k2", "internal", 1, "m", "uploaded", 1), ("/b", "k2", "internal", 1, "m", "error", 2)]
    jobs.record_uploads(spark, f"{base}/l", spark.createDataFrame(rows, kind), 1, "2024-02-01 00:00:00")
    got = {r.file_path: r.status for r in read_version(spark, f"{base}/l", 1, schemas.LEDGER).collect()}
    assert got == {"/a": "uploaded", "/b": "error"}


def test_stacks_survive_repeated_and_late_listings(spark):
    base = tempfile.mkdtemp(prefix="darkroom-sdup-")
    land, state, plans, ckpt = f"{base}/land", f"{base}/state", f"{base}/plans", f"{base}/ckpt"
    items = [{"id": "j1", "originalFileName": "A.JPG", "localDateTime": "t"}, {"id": "r1", "originalFileName": "A.RAF", "localDateTime": "t"}]
    for name in ("p1", "p2"):
        _write(f"{land}/{name}.json", json.dumps({"assets": {"items": items, "nextPage": None}}).encode())
    stream_stacks(spark, land, state, plans, ckpt)
    kind = "base_name string, asset_ids string, body string"
    assert [r.asset_ids for r in read_all(spark, plans, spark.createDataFrame([], kind).schema).collect()] == ["j1,r1"]
    _write(f"{land}/p3.json", json.dumps({"assets": {"items": items, "nextPage": None}}).encode())
    stream_stacks(spark, land, state, plans, ckpt)
    assert read_all(spark, plans, spark.createDataFrame([], kind).schema).count() == 1  # not asked for again


def test_search_by_a_one_digit_day_prunes_no_rows(spark):
    rows = spark.sql("SELECT timestamp_ntz'2024-01-20 00:00:00' AS date_taken, '2024-01' AS taken_month")
    assert metadata.find_photos(rows, date_from="2024-1-05").count() == 1


def test_a_folder_that_fails_to_list_fails_the_listing(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="darkroom-io-")
    _write(f"{base}/2024/a.jpg", b"x")
    reader = MediaFilesReader({"paths": base})

    def broken(path):
        raise PermissionError(path)

    parts = reader.partitions()
    monkeypatch.setattr(os, "scandir", broken)
    with pytest.raises(PermissionError):
        [row for p in parts for row in reader.read(p)]


def test_no_run_is_lost_on_a_reused_version(spark):
    """Two results in a row under one number, and batch, stream, batch."""
    base = tempfile.mkdtemp(prefix="darkroom-lost-")
    kind = "file_path string, s3_key string, source_type string, file_size long, md5_checksum string, status string"
    for path, version in (("/a", 1), ("/b", 2), ("/c", 2), ("/d", None)):
        jobs.record_uploads(spark, f"{base}/l", spark.createDataFrame([(path, "k", "internal", 1, "m", "uploaded")], kind), version, "2024-02-01 00:00:00")
    rows = read_version(spark, f"{base}/l", latest_version(spark, f"{base}/l"), schemas.LEDGER).collect()
    assert sorted(r.file_path for r in rows) == ["/a", "/b", "/c", "/d"] and latest_version(spark, f"{base}/l") == 4
    with pytest.raises(ValueError):
        write_version(spark.createDataFrame(rows, schemas.LEDGER), f"{base}/l", 3)

    images, exif, land, cat = f"{base}/images", f"{base}/exif", f"{base}/land", f"{base}/cat"
    record = lambda name: json.dumps([{"SourceFile": f"{images}/{name}", "CreateDate": "2024:01:02 03:04:05"}]).encode()
    _write(f"{images}/a.JPG", b"x")
    _write(f"{exif}/a.json", record("a.JPG"))
    jobs.run_catalogue(spark, images, exif, cat, 1, "2024-02-01 00:00:00")
    _write(f"{land}/s.json", record("s.JPG"))
    stream_catalogue(spark, land, cat, f"{base}/ckpt", "2024-02-02 00:00:00")
    _write(f"{images}/b.JPG", b"x")
    _write(f"{exif}/b.json", record("b.JPG"))
    jobs.run_catalogue(spark, images, exif, cat, 2, "2024-02-03 00:00:00")
    rows = read_version(spark, cat, latest_version(spark, cat), schemas.CATALOGUE).collect()
    assert sorted(os.path.basename(r.file_path) for r in rows) == ["a.JPG", "b.JPG", "s.JPG"]


def test_deletions_leave_the_ledger_only_when_confirmed(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="darkroom-del-")
    roots, ledger, audit = {"internal": f"{base}/int"}, f"{base}/ledger", f"{base}/audit"
    _write(f"{base}/int/here.jpg", b"1")
    kind = "file_path string, s3_key string, source_type string, file_size long, md5_checksum string, status string"
    names = ["gone", "fails", "retried", "silent", "here"]
    rows = [(f"{base}/int/{n}.jpg", f"internal/{n}.jpg", "internal", 1, "m", "uploaded") for n in names]
    jobs.record_uploads(spark, ledger, spark.createDataFrame(rows, kind), None, "2024-02-01 00:00:00")
    plan = lambda: {os.path.basename(r.file_path)[:-4] for r in jobs.plan_deletions(spark, roots, ledger, "bkt", "2024-02-02 00:00:00").collect()}
    left = lambda: {os.path.basename(r.file_path)[:-4] for r in read_version(spark, ledger, latest_version(spark, ledger), schemas.LEDGER).collect()}
    assert plan() == {"gone", "fails", "retried", "silent"} and left() == set(names)  # planning writes nothing

    report = [("gone", "deleted"), ("gone", "deleted"), ("fails", "failed"), ("retried", "failed"), ("retried", "deleted"), ("here", "deleted"), ("unknown", "deleted")]
    results = spark.createDataFrame([(f"{base}/int/{n}.jpg", o) for n, o in report], "file_path string, outcome string")
    record = lambda run: jobs.record_deletions(spark, roots, ledger, audit, results, "bkt", "2024-02-02 00:00:00", run).collect()
    real, writes = jobs.write_version, []

    def stops_at_the_ledger(df, where, *args, **options):
        writes.append(where)
        if where == ledger and writes.count(ledger) == 1:
            raise RuntimeError("stopped between the two commits")
        return real(df, where, *args, **options)

    monkeypatch.setattr(jobs, "write_version", stops_at_the_ledger)
    with pytest.raises(RuntimeError):
        record("report-1")
    counts = record("report-1")[0]
    assert (counts.planned, counts.deleted, counts.errors, counts.pending) == (4, 2, 1, 1)
    assert left() == {"fails", "silent", "here"} and plan() == {"fails", "silent"}
    record("report-1")  # applied once
    rows = read_all(spark, audit, schemas.AUDIT).orderBy("id").collect()
    assert [(r.id, r.s3_key) for r in rows] == [(1, "internal/gone.jpg"), (2, "internal/retried.jpg")]
    last = spark.createDataFrame([(f"{base}/int/fails.jpg", "deleted")], "file_path string, outcome string")
    jobs.record_deletions(spark, roots, ledger, audit, last, "bkt", "2024-02-03 00:00:00", "report-2")
    assert [r.id for r in read_all(spark, audit, schemas.AUDIT).orderBy("id").collect()] == [1, 2, 3]
    assert left() == {"silent", "here"}
