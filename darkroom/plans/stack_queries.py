"""Checked stacking queries over `events` (fixture fx_assets) and their DuckDB oracles."""

from __future__ import annotations

from darkroom.operators import stacks
from darkroom.sources.fixtures import Fixtures, duckdb_ctes


def q_stack_groups(spark, sf_dir):
    return stacks.stack_groups(Fixtures(spark, sf_dir).fx_assets)


def q_stack_members(spark, sf_dir):
    return stacks.stack_members(Fixtures(spark, sf_dir).fx_assets)


def q_stack_summary(spark, sf_dir):
    return stacks.stack_summary(Fixtures(spark, sf_dir).fx_assets)


def q_stack_requests(spark, sf_dir):
    return stacks.stack_requests(Fixtures(spark, sf_dir).fx_assets)


def q_stacked_assets(spark, sf_dir):
    from darkroom.plans.jobs import stacked_assets

    return stacked_assets(Fixtures(spark, sf_dir).fx_assets)


_CAND = r"""
cand AS (
  SELECT asset_id, coalesce(original_file_name, '') AS original_file_name,
         regexp_replace(coalesce(original_file_name, ''), '\.[^.]*$', '') AS base_name,
         coalesce(local_date_time, '') AS local_date_time
  FROM fx_assets WHERE coalesce(stack_count, 0) = 0),
keyed AS (
  SELECT *, lower(original_file_name) LIKE '%.jpg' OR lower(original_file_name) LIKE '%.jpeg' AS is_jpeg
  FROM cand WHERE base_name <> '' AND local_date_time <> ''),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY base_name, local_date_time
                               ORDER BY CASE WHEN is_jpeg THEN 0 ELSE 1 END, original_file_name, asset_id) AS member_rank,
         count(*) OVER (PARTITION BY base_name, local_date_time) AS n_members
  FROM keyed)"""

ORACLE = {
    "stack_groups": duckdb_ctes("fx_assets") + "," + _CAND + """
SELECT base_name, local_date_time, n_members, has_jpeg, parent_id, parent_name,
       row_number() OVER (ORDER BY base_name, local_date_time) AS group_no
FROM (SELECT base_name, local_date_time, max(n_members) AS n_members, bool_or(is_jpeg) AS has_jpeg,
             max(CASE WHEN member_rank = 1 THEN asset_id END) AS parent_id,
             max(CASE WHEN member_rank = 1 THEN original_file_name END) AS parent_name
      FROM ranked WHERE n_members > 1 GROUP BY base_name, local_date_time) g""",
    "stack_members": duckdb_ctes("fx_assets") + "," + _CAND + """
SELECT base_name, local_date_time, asset_id, original_file_name, is_jpeg,
       member_rank = 1 AS is_parent, member_rank
FROM ranked WHERE n_members > 1""",
    "stack_summary": duckdb_ctes("fx_assets") + "," + _CAND + """
SELECT (SELECT count(*) FROM fx_assets) AS assets,
       (SELECT count(*) FROM fx_assets WHERE coalesce(stack_count, 0) = 0) AS unstacked,
       (SELECT count(*) FROM keyed) AS keyed,
       (SELECT count(*) FROM (SELECT 1 FROM ranked WHERE n_members > 1 GROUP BY base_name, local_date_time) x) AS groups,
       (SELECT count(*) FROM ranked WHERE n_members > 1) AS members,
       (SELECT count(*) FROM (SELECT 1 FROM ranked WHERE n_members > 1 GROUP BY base_name, local_date_time
                              HAVING NOT bool_or(is_jpeg)) x) AS groups_without_jpeg""",
    "stack_requests": duckdb_ctes("fx_assets") + "," + _CAND + """
SELECT base_name, local_date_time, CAST(1 AS BIGINT) AS chunk,
       max(CASE WHEN member_rank = 1 THEN asset_id END) AS parent_id,
       count(*) AS n_ids,
       string_agg(CAST(asset_id AS VARCHAR), ',' ORDER BY member_rank) AS asset_ids,
       '{"assetIds":[' || string_agg(CAST(asset_id AS VARCHAR), ',' ORDER BY member_rank) || ']}' AS body
FROM ranked WHERE n_members > 1 GROUP BY base_name, local_date_time""",
    "stacked_assets": duckdb_ctes("fx_assets") + "," + _CAND + """
SELECT a.asset_id, a.original_file_name, a.local_date_time,
       CAST(coalesce(r.n_members, a.stack_count) AS INTEGER) AS stack_count
FROM fx_assets a LEFT JOIN (SELECT asset_id, n_members FROM ranked WHERE n_members > 1) r ON r.asset_id = a.asset_id""",
}

QUERIES = {
    "stack_groups": q_stack_groups,
    "stack_members": q_stack_members,
    "stack_summary": q_stack_summary,
    "stack_requests": q_stack_requests,
    "stacked_assets": q_stacked_assets,
}
