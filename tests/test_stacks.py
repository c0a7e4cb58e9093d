"""Stacking against a brute-force restatement of the script's grouping."""

import random
from itertools import groupby

from darkroom.operators.stacks import stack_groups, stack_members, stack_requests, stack_summary

SCHEMA = "asset_id long, original_file_name string, local_date_time string, stack_count int"


def brute(assets):
    unstacked = [a for a in assets if not a[3]]
    keyed = []
    for a in unstacked:
        name = a[1] or ""
        base = name.rsplit(".", 1)[0] if "." in name else name
        ts = a[2] or ""
        if base and ts:
            keyed.append(((base, ts), a))
    keyed.sort(key=lambda x: x[0])
    out = {}
    for key, grp in groupby(keyed, key=lambda x: x[0]):
        g = [x[1] for x in grp]
        if len(g) > 1:
            jpeg = lambda a: (a[1] or "").lower().endswith((".jpg", ".jpeg"))
            g.sort(key=lambda a: (0 if jpeg(a) else 1, a[1] or "", a[0]))
            out[key] = [a[0] for a in g]
    return out


EDGE = [
    (1, "DSCF1.JPG", "t1", None), (2, "DSCF1.RAF", "t1", None),          # JPG+RAF
    (3, "B.RAF", "t1", None), (4, "B.CR2", "t1", None),                  # no JPEG
    (5, "C.jpg", "t1", None), (6, "C.JPG", "t1", 0), (7, "C.RAF", "t1", None),  # two JPEGs
    (8, "nodot", "t1", None), (9, "nodot", "t1", None),                  # no dot
    (10, ".jpg", "t1", None), (11, ".raf", "t1", None),                  # empty stem
    (12, "E.JPG", "", None), (13, "E.RAF", None, None),                  # empty time
    (14, "S.JPG", "t1", 2), (15, "S.RAF", "t1", None),                   # one already stacked
    (16, "T.JPG", "t1", None), (17, "T.RAF", "t2", None),                # same base, two times
    (18, "a.b.JPG", "t1", None), (19, "a.b.dng", "t1", None),
]


def check(spark, assets):
    df = spark.createDataFrame(assets, SCHEMA)
    expected = brute(assets)
    groups = {(r.base_name, r.local_date_time): r for r in stack_groups(df).collect()}
    assert set(groups) == set(expected)
    for k, ids in expected.items():
        assert groups[k].parent_id == ids[0] and groups[k].n_members == len(ids)
    assert sorted(r.group_no for r in groups.values()) == list(range(1, len(groups) + 1))
    assert [groups[k].group_no for k in sorted(groups)] == list(range(1, len(groups) + 1))
    members = stack_members(df).collect()
    got = {}
    for r in sorted(members, key=lambda r: r.member_rank):
        got.setdefault((r.base_name, r.local_date_time), []).append(r.asset_id)
    assert got == expected
    return df, expected


def test_edge_rows(spark):
    df, expected = check(spark, EDGE)
    assert ("DSCF1", "t1") in expected and ("S", "t1") not in expected and ("", "t1") not in expected
    s = stack_summary(df).first()
    assert (s.groups, s.members, s.groups_without_jpeg) == (len(expected), sum(map(len, expected.values())), 2)
    req = {(r.base_name, r.local_date_time): r for r in stack_requests(df).collect()}
    assert req[("DSCF1", "t1")].body == '{"assetIds":[1,2]}'


def test_hot_group_and_chunks(spark):
    # One key holds a third of all rows; positions must still be exact.
    rnd = random.Random(7)
    assets = [(i, f"HOT.{rnd.choice(['JPG', 'RAF', 'CR2'])}", "t0", None) for i in range(3000)]
    assets += [(10000 + i, f"N{i % 2000}.{rnd.choice(['JPG', 'RAF'])}", f"t{i % 3}", None) for i in range(6000)]
    df, expected = check(spark, assets)
    req = stack_requests(df, chunk_size=1000).where("base_name = 'HOT'").orderBy("chunk").collect()
    assert [r.n_ids for r in req] == [1000, 1000, 1000]
    ids = [int(x) for r in req for x in r.asset_ids.split(",")]
    assert ids == expected[("HOT", "t0")]
    assert all(r.body.startswith('{"assetIds":[' + str(ids[0]) + ",") for r in req)  # one kind of body, parent first
