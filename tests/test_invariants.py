"""Invariants of the plans on the driver tables (sf0.01): each asset in at
most one stack, ranks dense from the parent, plan keys unique, ids of a
merge unique and dense past the old maximum, every asset kept once."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from darkroom.operators import merge
from darkroom.plans import catalogue_queries as C
from darkroom.plans.backup_queries import _plan as backup_plan
from darkroom.plans.backup_queries import upload_results
from darkroom.sources.fixtures import RUN_TS, Fixtures

SF = "/root/testdata/sf0.01"
Q = entry.queries()


def _dupes(df, *cols):
    return df.groupBy(*cols).count().where("count > 1").count()


def test_each_asset_in_at_most_one_stack(spark):
    members = Q["stack_members"](spark, SF)
    assert _dupes(members, "asset_id") == 0
    per_group = members.groupBy("base_name", "local_date_time").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("member_rank").alias("top"),
        F.min("member_rank").alias("low"),
        F.count(F.when(F.col("is_parent"), 1)).alias("parents"),
    )
    assert per_group.where("low <> 1 OR top <> n OR parents <> 1 OR n < 2").count() == 0
    groups = Q["stack_groups"](spark, SF)
    joined = groups.join(per_group, ["base_name", "local_date_time"], "full_outer")
    assert joined.where("n IS NULL OR n_members IS NULL OR n <> n_members").count() == 0
    # Group numbers are 1..G in key order.
    g = groups.agg(F.count(F.lit(1)).alias("g"), F.max("group_no").alias("m"), F.countDistinct("group_no").alias("d")).first()
    assert g.g == g.m == g.d


def test_stacked_assets_keeps_every_asset_once(spark):
    assets = Fixtures(spark, SF).fx_assets
    out = Q["stacked_assets"](spark, SF)
    assert out.count() == assets.count() and _dupes(out, "asset_id") == 0


def test_plan_keys_unique(spark):
    assert _dupes(Q["upload_plan"](spark, SF), "file_path") == 0
    assert _dupes(Q["upload_plan"](spark, SF), "s3_key") == 0
    copy = Q["copy_plan"](spark, SF)
    assert _dupes(copy, "file_path") == 0
    assert _dupes(copy.where("action = 'copy'"), "file_name") == 0
    assert _dupes(Q["merge_catalogue"](spark, SF), "file_path") == 0
    assert _dupes(Q["merge_ledger"](spark, SF), "file_path") == 0


@pytest.mark.parametrize("which", ["catalogue", "ledger"])
def test_merge_ids_unique_and_dense(spark, which):
    fx = Fixtures(spark, SF)
    if which == "catalogue":
        old, todo = C._work(spark, SF)
        incoming, _ = merge.check_keys(C.metadata.exif_fields(todo))
        out = merge.merge_catalogue(old, incoming, RUN_TS)
    else:
        old = fx.fx_ledger
        accepted, _ = merge.check_keys(upload_results(backup_plan(fx)))
        out = merge.merge_ledger(old, accepted, RUN_TS)
    kept = old.select("id", "file_path")
    start = old.agg(F.max("id")).first()[0]
    # Existing rows keep their id.
    assert out.join(kept, "file_path").where(out["id"] != kept["id"]).count() == 0
    fresh = out.join(kept, "file_path", "left_anti")
    n = fresh.count()
    assert n > 0
    s = fresh.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.countDistinct("id").alias("d")).first()
    assert (s.lo, s.hi, s.d) == (start + 1, start + n, n)
    # Dense in path order.
    ordered = [r.id for r in fresh.orderBy("file_path").select("id").collect()]
    assert ordered == list(range(start + 1, start + n + 1))
