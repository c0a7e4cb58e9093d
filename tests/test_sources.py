"""Listing source and landed-JSON readers on temporary folders."""

import hashlib
import json
import os
import tempfile

from darkroom.constants import BACKUP_EXCLUDE_DIRS
from darkroom.operators.listing import backup_listing, metadata_listing
from darkroom.operators.stacks import stack_groups
from darkroom.sources.json_records import libraries_to_scan, read_asset_pages, read_exif_json, read_libraries
from darkroom.sources.media_files import list_media

FILES = [
    "a.jpg", "b.JPG", "c.Jpg", "notes.txt", "noext", "_DSC1.JPG", ".h.JPG", "_sub/b.JPG", "x y.JPG", "#1.png",
    "%20.raf", "thumbs/t.jpg", "profile/p.jpg", "profiles/p.jpg", "library/l.jpg", "2024/01/02/deep.NEF",
]


def _tree(files):
    root = tempfile.mkdtemp(prefix="darkroom-src-")
    for i, f in enumerate(files):
        p = os.path.join(root, f)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(f"content {i} {f}".encode() * (i + 1))
    return root


def test_list_media_keeps_hidden_names_and_checksums(spark):
    root = _tree(FILES)
    df = list_media(spark, {"internal": root, "external": root + "-missing"}, checksum=True)
    rows = {os.path.relpath(r.file_path, root): r for r in df.collect()}
    assert set(rows) == set(FILES)
    for rel, r in rows.items():
        with open(os.path.join(root, rel), "rb") as fh:
            data = fh.read()
        assert r.md5_checksum == hashlib.md5(data).hexdigest() and r.file_size == len(data)
        assert r.source_type == "internal"


def test_listing_rules_on_real_tree(spark):
    root = _tree(FILES)
    df = list_media(spark, [root], split_depth=2)
    meta = {os.path.relpath(r.file_path, root) for r in metadata_listing(df).collect()}
    back = {os.path.relpath(r.file_path, root) for r in backup_listing(df).collect()}
    assert meta == {"a.jpg", "b.JPG", "_DSC1.JPG", ".h.JPG", "_sub/b.JPG", "x y.JPG", "#1.png", "%20.raf",
                    "profile/p.jpg", "2024/01/02/deep.NEF"}
    assert back == (meta | {"c.Jpg", "library/l.jpg"})
    pruned = {os.path.relpath(r.file_path, root) for r in list_media(spark, [root], exclude=BACKUP_EXCLUDE_DIRS).collect()}
    assert "thumbs/t.jpg" not in pruned and "library/l.jpg" in pruned


def test_read_exif_json(spark):
    d = tempfile.mkdtemp(prefix="darkroom-exif-")
    docs = {
        "a.json": json.dumps([{"SourceFile": "/img/a.JPG", "Make": "FUJIFILM", "ISO": 200}]),
        "b.json": json.dumps([{}]),
        "c.json": "[]",
        "d.json": "not json",
        "e.json": json.dumps([{"Make": "Canon"}]),
    }
    for k, v in docs.items():
        with open(os.path.join(d, k), "w") as fh:
            fh.write(v)
    recs, rejects = read_exif_json(spark, d)
    got = {r.file_path: json.loads(r.metadata_json) for r in recs.collect()}
    assert got["/img/a.JPG"]["Make"] == "FUJIFILM"
    assert any(p.endswith("e.json") for p in got) and len(got) == 2
    assert sorted(os.path.basename(r.landed_path) for r in rejects.collect()) == ["b.json", "c.json", "d.json"]


def test_asset_pages_to_stacks(spark):
    d = tempfile.mkdtemp(prefix="darkroom-pages-")
    pages = [
        {"assets": {"items": [{"id": "u1", "originalFileName": "DSCF1.JPG", "localDateTime": "t"},
                              {"id": "u2", "originalFileName": "DSCF1.RAF", "localDateTime": "t", "stackCount": None}],
                    "nextPage": "2"}},
        {"assets": {"items": [{"id": "u3", "originalFileName": "DSCF2.RAF", "localDateTime": "t", "stackCount": 2}],
                    "nextPage": None}},
    ]
    for i, p in enumerate(pages):
        with open(os.path.join(d, f"page{i}.json"), "w") as fh:
            json.dump(p, fh)
    assets = read_asset_pages(spark, d)
    assert assets.count() == 3
    g = stack_groups(assets).collect()
    assert [(r.base_name, r.parent_id, r.n_members) for r in g] == [("DSCF1", "u1", 2)]


def test_libraries(spark):
    d = tempfile.mkdtemp(prefix="darkroom-libs-")
    with open(os.path.join(d, "libs.json"), "w") as fh:
        json.dump([{"id": "1", "name": "Ext", "type": "EXTERNAL"}, {"id": "2"}, {"id": "3", "type": None, "name": None}], fh)
    libs = {r.id: r for r in read_libraries(spark, d).collect()}
    assert (libs["2"].name, libs["2"].type) == ("Unnamed", "UPLOAD")
    assert (libs["3"].name, libs["3"].type) == (None, None)
    ext = sorted(r.id for r in libraries_to_scan(read_libraries(spark, d), external_only=True).collect())
    assert ext == ["1", "3"]


def test_links_to_files_are_listed(spark):
    root = _tree(["a.jpg", "sub/b.jpg"])
    os.symlink(os.path.join(root, "a.jpg"), os.path.join(root, "link.jpg"))
    os.symlink(os.path.join(root, "sub"), os.path.join(root, "linkdir"))
    got = {os.path.relpath(r.file_path, root): r.file_size for r in list_media(spark, [root + "/"]).collect()}
    assert set(got) == {"a.jpg", "sub/b.jpg", "link.jpg"}
    assert got["link.jpg"] == got["a.jpg"]


def test_with_checksum_spreads_a_hot_folder(spark):
    from darkroom.functions.checksum import with_checksum

    files = [f"hot/{i:03d}.JPG" for i in range(40)]
    root = _tree(files)
    paths = [(os.path.join(root, f),) for f in files] + [(os.path.join(root, "gone.JPG"),)]
    df = spark.createDataFrame(paths, "file_path string").coalesce(1)  # one folder, one task
    out = with_checksum(df)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out.rdd.getNumPartitions() == parts
    got = {r.file_path: r.md5_checksum for r in out.collect()}
    assert got.pop(os.path.join(root, "gone.JPG")) is None
    for path, digest in got.items():
        with open(path, "rb") as fh:
            assert digest == hashlib.md5(fh.read()).hexdigest()
