"""RAW+JPEG stacking: group unstacked assets of one shot, pick the parent.

Input columns (asset listing, FIXTURES A5 flattened): asset_id,
original_file_name, local_date_time (text), stack_count.

Group statistics and the parent come from partial (map-side) aggregates, so a
hot (name, time) key never gathers its members in one task; member positions
come from the balanced ordinal in `darkroom.operators.ordinal`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from darkroom.functions.names import is_jpeg, stem
from darkroom.operators.ordinal import with_ordinal

KEY = ("base_name", "local_date_time")


def stack_candidates(assets: DataFrame) -> DataFrame:
    """Unstacked assets with a usable key: stack_count NULL/absent/0 is
    unstacked; an empty stem or empty time drops the asset."""
    name = F.coalesce(F.col("original_file_name"), F.lit(""))
    return (
        assets.where(F.coalesce(F.col("stack_count"), F.lit(0)) == 0)
        .select(
            "asset_id",
            name.alias("original_file_name"),
            stem(name).alias("base_name"),
            F.coalesce(F.col("local_date_time"), F.lit("")).alias("local_date_time"),
        )
        .where((F.col("base_name") != "") & (F.col("local_date_time") != ""))
        .withColumn("is_jpeg", is_jpeg("original_file_name"))
        # Parent preference: JPEG first, then file name, then id (fetch order stand-in).
        .withColumn("jpeg_rank", F.when(F.col("is_jpeg"), 0).otherwise(1))
    )


def stack_groups(assets: DataFrame) -> DataFrame:
    """One row per (base_name, local_date_time) with more than one member:
    n_members, has_jpeg, parent_id, parent_name, group_no (position in key order)."""
    cand = stack_candidates(assets)
    groups = (
        cand.groupBy(*KEY)
        .agg(
            F.count(F.lit(1)).alias("n_members"),
            F.max("is_jpeg").alias("has_jpeg"),
            F.min(F.struct("jpeg_rank", "original_file_name", "asset_id")).alias("_parent"),
        )
        .where(F.col("n_members") > 1)
        .select(
            *KEY,
            "n_members",
            "has_jpeg",
            F.col("_parent.asset_id").alias("parent_id"),
            F.col("_parent.original_file_name").alias("parent_name"),
        )
    )
    return with_ordinal(groups, list(KEY), name="group_no")


def stack_members(assets: DataFrame) -> DataFrame:
    """One row per member of a stack group, with its role and its position
    (1 = parent) in (JPEG first, file name, id) order."""
    cand = stack_candidates(assets)
    sizes = cand.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_members")).where(F.col("n_members") > 1)
    # Group table has one row per key; AQE splits a hot key on the member side.
    members = cand.join(sizes, list(KEY), "left_semi")
    ranked = with_ordinal(
        members, ["jpeg_rank", "original_file_name", "asset_id"], partition_by=KEY, name="member_rank"
    )
    return ranked.select(
        *KEY,
        "asset_id",
        "original_file_name",
        "is_jpeg",
        (F.col("member_rank") == 1).alias("is_parent"),
        "member_rank",
    )


def stack_summary(assets: DataFrame) -> DataFrame:
    """Run totals from one two-level aggregation (no join): assets fetched,
    unstacked, keyed, groups, members, groups without a JPEG."""
    name = F.coalesce(F.col("original_file_name"), F.lit(""))
    unstacked = F.coalesce(F.col("stack_count"), F.lit(0)) == 0
    ldt = F.coalesce(F.col("local_date_time"), F.lit(""))
    keyed = unstacked & (stem(name) != "") & (ldt != "")
    flagged = assets.select(
        F.when(keyed, stem(name)).alias("base_name"),
        F.when(keyed, ldt).alias("local_date_time"),
        unstacked.alias("unstacked"),
        is_jpeg(name).alias("is_jpeg"),
    )
    # Rows without a key share one (NULL, NULL) group; partial aggregation keeps it cheap.
    per_key = flagged.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("unstacked"), 1)).alias("n_unstacked"),
        F.max("is_jpeg").alias("has_jpeg"),
    )
    is_key = F.col("base_name").isNotNull()
    group = is_key & (F.col("n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("assets"),
        F.coalesce(F.sum("n_unstacked"), F.lit(0)).cast("bigint").alias("unstacked"),
        F.coalesce(F.sum(F.when(is_key, F.col("n"))), F.lit(0)).cast("bigint").alias("keyed"),
        F.count(F.when(group, 1)).alias("groups"),
        F.coalesce(F.sum(F.when(group, F.col("n"))), F.lit(0)).cast("bigint").alias("members"),
        F.count(F.when(group & ~F.col("has_jpeg"), 1)).alias("groups_without_jpeg"),
    )


def stack_requests(assets: DataFrame, chunk_size: int = 1000) -> DataFrame:
    """Request bodies per stack, `{"assetIds": [parent, members...]}`, the same
    kind for every group: a group of more than `chunk_size` members has several,
    each with the parent first, so no body gathers a huge group."""
    m = stack_members(assets).withColumn("chunk", F.ceil(F.col("member_rank") / F.lit(chunk_size)).cast("bigint"))
    # The parent (rank 1) from a partial aggregate: the same order as the
    # ranking, without ranking the members a second time.
    parents = (
        stack_candidates(assets)
        .groupBy(*KEY)
        .agg(F.min(F.struct("jpeg_rank", "original_file_name", "asset_id")).alias("_p"))
        .select(*KEY, F.col("_p.asset_id").alias("parent_id"))
    )
    chunks = m.groupBy(*KEY, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("member_rank", "asset_id"))).alias("_m"),
        F.count(F.lit(1)).alias("n_ids"),
    )
    ids = F.transform(F.col("_m"), lambda x: x["asset_id"])
    out = chunks.join(parents, list(KEY), "inner")
    head = F.when(F.col("chunk") > 1, F.array("parent_id")).otherwise(F.slice(F.array("parent_id"), 1, 0))
    body = F.to_json(F.struct(F.concat(head, ids).alias("assetIds")))
    return out.select(
        *KEY,
        "chunk",
        "parent_id",
        "n_ids",
        F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("asset_ids"),
        body.alias("body"),
    )
