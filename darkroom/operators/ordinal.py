"""Row numbers within groups that stay balanced when one group is huge.

`row_number() over (partition by g order by o)` sends a whole group to one
task; with one key holding a third of the rows that task is the job.

Here rows are range-partitioned on the composite key (g, o) by
`repartitionByRange` (Spark samples the boundaries), so a hot group is cut
into contiguous slices. The result is written once with each row's partition
number as its slice; everything after reads those files, so a lost executor
cannot move a row to another slice. Rows are numbered inside (slice, g), and
the sizes of (slice, g), one row per slice and group, give the offsets that
are joined back.

Order columns are ascending (NULLs first) and must make a total order (end
with a unique column) for repeatable numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from darkroom.session import materialize

_SLICE = "_ord_slice"
_LOCAL = "_ord_local"
_OFFSET = "_ord_offset"


def with_ordinal(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    name: str = "ordinal",
    slices: int | None = None,
) -> DataFrame:
    """Add `name`: 1-based position of each row in `order_by` order (column
    names, ascending) within its `partition_by` group (whole table when
    empty). Writes the range-partitioned input once when called."""
    keys = list(partition_by)
    order = list(order_by)
    ranged = df.repartitionByRange(slices, *keys, *order) if slices else df.repartitionByRange(*keys, *order)
    sliced = materialize(ranged.withColumn(_SLICE, F.spark_partition_id()), "ordinal-input")

    w = Window.partitionBy(_SLICE, *keys).orderBy(*order)
    local = sliced.withColumn(_LOCAL, F.row_number().over(w))
    sizes = sliced.groupBy(_SLICE, *keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(_SLICE).alias("_o_slice"),
        *[F.col(k).alias("_o_" + k) for k in keys],
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias(_OFFSET),
    )
    if not keys:
        # One row per range partition: bounded by spark.sql.shuffle.partitions.
        offsets = F.broadcast(offsets)
    cond = F.col(_SLICE) == F.col("_o_slice")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col("_o_" + k))
    joined = local.join(offsets, cond, "inner")
    return joined.withColumn(name, (F.col(_OFFSET) + F.col(_LOCAL)).cast("bigint")).drop(
        _SLICE, _LOCAL, _OFFSET, "_o_slice", *["_o_" + k for k in keys]
    )
