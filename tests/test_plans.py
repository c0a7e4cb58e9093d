"""Plan shape of every registered query: no cartesian products or nested-loop
joins, no Python evaluation in the query path, filters reach the scan."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from darkroom.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join_or_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for word in FORBIDDEN:
        assert word not in plan, f"{name}: {word}"


def test_filters_and_columns_reach_the_scan(spark):
    from darkroom.plans.catalogue_queries import previous_catalogue
    from darkroom.sources.fixtures import Fixtures

    plan = _plan(previous_catalogue(Fixtures(spark, SF).fx_exif))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in plan
    # The work list reads the stored previous catalogue: complete-row filter at its scan.
    plan = _plan(entry.queries()["catalogue_work_list"](spark, SF))
    assert "PushedFilters: [IsNotNull(date_taken), IsNotNull(metadata_json)" in plan
    plan = _plan(entry.queries()["stack_summary"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_date_search_prunes_months_and_pushes_bounds(spark):
    plan = _plan(entry.queries()["photos_by_date"](spark, SF))
    assert "PartitionFilters: [isnotnull(taken_month" in plan and "(taken_month" in plan
    assert "PushedFilters: [IsNotNull(date_taken), GreaterThanOrEqual(date_taken," in plan


def test_merge_reuses_the_path_partitioning(spark):
    from darkroom.plans.catalogue_queries import _merged

    plan = _plan(_merged(spark, SF, assign_ids=False))
    # Accepted raw records are partitioned by path once; the full outer join
    # needs no second exchange on the incoming side.
    assert "REPARTITION_BY_COL" in plan
    assert "hashpartitioning(n_file_path" not in plan
