"""Deletion sync guards and card-import rules on hand-written rows."""

import datetime as dt

from darkroom.operators.backup import deletion_audit, flag_deletions, ledger_after_deletion, upload_plan
from darkroom.operators.ingest import card_files, copy_plan, copy_summary, route_volume

LEDGER = ("id long, file_path string, s3_key string, source_type string, file_size long, uploaded_at timestamp_ntz, "
          "last_verified_at timestamp_ntz, md5_checksum string, status string")
ROOTS = {"internal": "/srv/images", "external": "/mnt/ext/images", "immich_upload": "/srv/lib_up/upload"}
D = dt.datetime(2024, 1, 1)


def _ledger(spark):
    rows = [
        (1, "/srv/images/gone.jpg", "internal/gone.jpg", "internal", 1, D, None, "m", "uploaded"),
        (2, "/srv/images/here.jpg", "internal/here.jpg", "internal", 1, D, None, "m", "uploaded"),
        (3, "/srv/images2/sibling.jpg", "internal/sibling.jpg", "internal", 1, D, None, "m", "uploaded"),
        (4, "/srv/images/err.jpg", "internal/err.jpg", "internal", 1, D, None, "m", "error"),
        (5, "/mnt/ext/images/gone.jpg", "internal/x.jpg", "internal", 1, D, None, "m", "uploaded"),  # source mismatch
        (6, "/mnt/ext/images/a.jpg", "external/a.jpg", "external", 1, D, None, "m", "uploaded"),  # root lists nothing
        (7, "/srv/lib_up/upload/b.jpg", "immich_upload/b.jpg", "immich_upload", 1, D, None, "m", "uploaded"),
        (8, "/srv/lib_uXup/upload/c.jpg", "immich_upload/c.jpg", "immich_upload", 1, D, None, "m", "uploaded"),
    ]
    return spark.createDataFrame(rows, LEDGER)


def test_deletion_guards(spark):
    on_disk = spark.createDataFrame(
        [("/srv/images/here.jpg", "internal"), ("/srv/images/notes.txt", "internal"), ("/srv/lib_up/upload/z.jpg", "immich_upload")],
        "file_path string, source_type string",
    )
    flagged = flag_deletions(_ledger(spark), on_disk, ROOTS)
    deleted = sorted(r.id for r in flagged.where("deleted").collect())
    # 1: gone below its root; 7: gone. Not 3 (sibling root), 4 (status error), 5 (other source),
    # 6 (external root lists no file: treated as unmounted), 8 ('_' is not a wildcard).
    assert deleted == [1, 7]
    audit = deletion_audit(flagged, "bkt", "2024-02-01 00:00:00").collect()
    assert {r.s3_full_path for r in audit} == {"s3://bkt/internal/gone.jpg", "s3://bkt/immich_upload/b.jpg"}
    assert all(r.original_status == "uploaded" and r.deleted_at == dt.datetime(2024, 2, 1) for r in audit)
    remaining = sorted(r.id for r in ledger_after_deletion(flagged).collect())
    assert remaining == [2, 3, 4, 5, 6, 8]
    # Ledger and audit partition the old ledger.
    assert len(remaining) + len(audit) == _ledger(spark).count()


def test_deletion_missing_root_not_available(spark):
    on_disk = spark.createDataFrame([("/srv/images/here.jpg", "internal")], "file_path string, source_type string")
    flagged = flag_deletions(_ledger(spark), on_disk, ROOTS, available=["external"])
    assert flagged.where("deleted").count() == 0


def test_upload_plan_retries_errors(spark):
    inv = spark.createDataFrame(
        [("/srv/images/here.jpg", "internal", 5, "h"), ("/srv/images/err.jpg", "internal", 6, "e"), ("/srv/images/new.jpg", "internal", 7, "n")],
        "file_path string, source_type string, file_size long, md5_checksum string",
    )
    plan = upload_plan(inv, _ledger(spark), ROOTS, "bkt", "2024-02-01T00:00:00").collect()
    assert sorted(r.s3_key for r in plan) == ["internal/err.jpg", "internal/new.jpg"]
    assert "storage_class" not in plan[0].asDict()
    deep = upload_plan(inv, _ledger(spark), ROOTS, "bkt", "2024-02-01T00:00:00", storage_class="DEEP_ARCHIVE")
    assert {r.storage_class for r in deep.collect()} == {"DEEP_ARCHIVE"}


def test_copy_plan_rules(spark):
    card = spark.createDataFrame([(p,) for p in [
        "/card/DCIM/100/IMG_20240131_1.jpg",
        "/card/DCIM/100/DSC_12345678.jpg",
        "/card/DCIM/100/DSCF0001.RAF",
        "/card/DCIM/101/DSCF0001.RAF",     # same name twice on the card
        "/card/DCIM/101/OLD_0001.JPG",     # already at the destination in another folder
        "/card/DCIM/101/notes.txt",
        "/card/MISC/other.jpg",            # outside the DCIM folder
    ]], "file_path string")
    dest = spark.createDataFrame([("/srv/images/2020/01/01/OLD_0001.JPG",)], "file_path string")
    plan = {r.file_path: r for r in copy_plan(card_files(card), dest, "/srv/images", "2024/02/01").collect()}
    assert set(plan) == {p for p in plan} and "/card/MISC/other.jpg" not in plan and "/card/DCIM/101/notes.txt" not in plan
    assert plan["/card/DCIM/100/IMG_20240131_1.jpg"].dest_path == "/srv/images/2024/01/31/IMG_20240131_1.jpg"
    assert plan["/card/DCIM/100/DSC_12345678.jpg"].dest_dir == "/srv/images/1234/56/78"
    assert plan["/card/DCIM/100/DSCF0001.RAF"].dest_dir == "/srv/images/2024/02/01"
    assert (plan["/card/DCIM/101/DSCF0001.RAF"].action, plan["/card/DCIM/101/DSCF0001.RAF"].reason) == ("skip", "duplicate_on_card")
    assert plan["/card/DCIM/101/OLD_0001.JPG"].reason == "exists_at_destination"
    s = copy_summary(copy_plan(card_files(card), dest, "/srv/images", "2024/02/01")).first()
    assert (s.copied, s.skipped) == (3, 2)


def test_card_without_dcim_and_lowercase_dcim(spark):
    card = spark.createDataFrame([("/c/a.JPG",), ("/c/sub/b.nef",), ("/d/dcim/x/c.jpg",), ("/d/e.jpg",)], "file_path string")
    card = card.selectExpr("file_path", "split(file_path, '/')[1] AS card")
    got = sorted(r.file_path for r in card_files(card, card_col="card").collect())
    assert got == ["/c/a.JPG", "/c/sub/b.nef", "/d/dcim/x/c.jpg"]


def test_route_volume(spark):
    def route(rows):
        df = spark.createDataFrame(rows, "volume string, path string, exists boolean, free_gb string")
        return tuple(route_volume(df).first())[:2]

    ext = ("external", "/mnt/ext/images")
    assert route([("internal", "/srv/images", True, "5"), ("external", "/mnt/ext/images", True, "900")]) == ext
    assert route([("internal", "/srv/images", True, "50"), ("external", "/mnt/ext/images", True, "900")]) == ("internal", "/srv/images")
    assert route([("internal", "/srv/images", True, "n/a"), ("external", "/mnt/ext/images", True, "1")]) == ext
    assert route([("internal", "/srv/images", False, "0"), ("external", "/mnt/ext/images", True, "1")]) == ("internal", "/srv/images")


def test_resolve_names(spark):
    from darkroom.operators.ingest import resolve_names

    card = spark.createDataFrame([("/card/DCIM/A.jpg",), ("/card/DCIM/B.jpg",), ("/card/DCIM/C.nef",), ("/card/DCIM/D_1.jpg",)],
                                 "file_path string")
    plan = copy_plan(card_files(card), spark.createDataFrame([], "file_path string"), "/lib", "2024/02/01")
    d = "/lib/2024/02/01"
    # Taken entries that the name check does not see (links, folders), and suffixes already used.
    occupied = spark.createDataFrame(
        [(f"{d}/A.jpg",), (f"{d}/A_1.jpg",), (f"{d}/A_3.jpg",), (f"{d}/C.nef",), (f"{d}/C_01.nef",), (f"{d}/D.jpg",)],
        "path string",
    )
    out = {r.file_path.rsplit("/", 1)[1]: r for r in resolve_names(plan, occupied).collect()}
    assert (out["A.jpg"].dest_path, out["A.jpg"].renamed) == (f"{d}/A_2.jpg", True)
    assert (out["B.jpg"].dest_path, out["B.jpg"].renamed) == (f"{d}/B.jpg", False)
    assert out["C.nef"].dest_path == f"{d}/C_1.nef"  # '_01' is not the suffix 1
    assert out["D_1.jpg"].dest_path == f"{d}/D_1.jpg"


def test_hot_name_on_card_and_hot_duplicate_key(spark):
    from pyspark.sql import functions as F

    from darkroom.operators.merge import check_keys

    # A third of the card shares one name.
    paths = [(f"/card/DCIM/{i:05d}/HOT.JPG",) for i in range(3000)] + [(f"/card/DCIM/x/N{i}.JPG",) for i in range(6000)]
    card = spark.createDataFrame(paths, "file_path string")
    dest = spark.createDataFrame([("/lib/2020/01/01/N7.JPG",)], "file_path string")
    plan = copy_plan(card_files(card), dest, "/lib", "2024/02/01")
    rows = plan.select((F.col("file_name") == "HOT.JPG").alias("hot"), "action", "reason").collect()
    counts = {}
    for r in rows:
        counts[(r.hot, r.action, r.reason)] = counts.get((r.hot, r.action, r.reason), 0) + 1
    assert counts[(True, "copy", None)] == 1
    assert counts[(True, "skip", "duplicate_on_card")] == 2999
    assert counts[(False, "skip", "exists_at_destination")] == 1
    first = plan.where("action = 'copy' AND file_name = 'HOT.JPG'").first()
    assert first.file_path == "/card/DCIM/00000/HOT.JPG"
    acc, rej = check_keys(card.withColumn("file_name", F.regexp_extract("file_path", "[^/]*$", 0)), key="file_name")
    assert rej.count() == 3000 and acc.count() == 6000


def test_cards_are_imported_in_order(spark):
    from pyspark.sql import functions as F

    cards = spark.createDataFrame([("a", "/a/1/X.jpg"), ("a", "/a/2/X.jpg"), ("b", "/b/X.jpg"), ("b", "/b/Y.jpg"), ("b", "/b/Z.jpg")], "card string, file_path string")
    plan = copy_plan(cards, spark.createDataFrame([("/lib/Z.jpg",)], "file_path string"), "/lib", "2024/02/01", card_col="card")
    assert {r.file_path: r.reason for r in plan.collect()} == {
        "/a/1/X.jpg": None, "/a/2/X.jpg": "duplicate_on_card", "/b/X.jpg": "exists_at_destination", "/b/Y.jpg": None, "/b/Z.jpg": "exists_at_destination"}


def test_hot_name_join_is_split(spark):
    """One name on a third of the files: the join's file side has a shuffle of
    its own, whose skewed partition AQE splits."""
    from pyspark.sql import functions as F

    files = spark.range(60_000).select(F.concat(F.lit("/c/"), F.col("id").cast("string"), F.lit("/"), F.when(F.col("id") % 3 == 0, F.lit("HOT.jpg")).otherwise(F.concat(F.col("id").cast("string"), F.lit(".jpg")))).alias("file_path"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        plan = copy_plan(files, spark.createDataFrame([], "file_path string"), "/lib", "2024/02/01")
        rows = plan.groupBy("action").count().collect()
        assert {r["action"]: r["count"] for r in rows} == {"copy": 40_001, "skip": 19_999}
        counted = plan.where("action = 'skip'")
        counted.write.format("noop").mode("overwrite").save()
        collected = counted.collect()
        assert len(collected) == 19_999 and "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
