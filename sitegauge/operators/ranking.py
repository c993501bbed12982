"""Ranking, running sums and sorts.

``Window.partitionBy(region).orderBy(score)`` would put every row of a region
into one task; with a handful of regions, one of them can hold a third of all
rows. :func:`rank_within` instead range-partitions on (group, order) so every
task gets a balanced slice of the global order, counts rows per (slice, group)
and turns those counts into offsets. The per-slice row numbers are computed
over balanced slices, and the offsets table has at most ``slices + groups``
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.session import freeze


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                out: str = "rank", slices: int | None = None,
                slice_out: str | None = None) -> DataFrame:
    """Row number 1..n per ``group`` in ``order`` (ties must be broken by the
    caller, e.g. with a unique key as the last order column).

    Rows with a NULL group value get a NULL rank, like a pandas ``groupby``
    cumulative sum. ``slice_out`` names an optional output column with the
    slice (task) each row was ranked in, for diagnostics.
    """
    group = list(group)
    has_group = _all_not_null(group)
    sort_keys = [F.col(g).asc_nulls_last() for g in group] + list(order)
    # Range partitioning samples its input in a job of its own: keep the input
    # cached for that job and the write below, so it is computed once. Once
    # the bounds are fixed a row's slice depends on its values only, so a
    # recomputed (lost) cache block lands in the same slices. The slice ids
    # are then frozen so the counts and the row numbers see the same slices.
    # Without an explicit count the range exchange uses the session's shuffle
    # partitions and AQE may coalesce small ones; coalescing only merges
    # adjacent ranges, so every slice is still one contiguous, ordered range.
    src = df.persist()
    ranged = (src.repartitionByRange(slices, *sort_keys) if slices
              else src.repartitionByRange(*sort_keys))
    sliced = freeze(ranged.withColumn("_slice", F.spark_partition_id()), "rank")
    src.unpersist()
    grouped = sliced.where(has_group)
    counts = grouped.groupBy("_slice", *group).agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*group).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        "_slice", *group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    in_slice = Window.partitionBy("_slice", *group).orderBy(*order)
    ranked = (grouped.join(offsets, ["_slice", *group])
              .withColumn(out, (F.row_number().over(in_slice) + F.col("_offset")).cast("long"))
              .drop("_offset"))
    no_group = sliced.where(~has_group).withColumn(out, F.lit(None).cast("long"))
    result = ranked.unionByName(no_group)
    if slice_out:
        return result.withColumnRenamed("_slice", slice_out)
    return result.drop("_slice")


def _all_not_null(cols: Sequence[str]) -> Column:
    acc = F.lit(True)
    for c in cols:
        acc = acc & F.col(c).isNotNull()
    return acc


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                value: str, out: str) -> DataFrame:
    """Cumulative sum of ``value`` per group in ``order``.

    Meant for per-key series of bounded length (periods of a site); for
    unbounded groups use :func:`rank_within`'s slicing pattern.
    """
    w = (Window.partitionBy(*group).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(value).over(w))


def sort_nulls_last(df: DataFrame, cols: Sequence[str], ascending: Sequence[bool]) -> DataFrame:
    """Multi-key mixed-direction sort with NULLs last in both directions (O1)."""
    keys = [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last()
            for c, a in zip(cols, ascending)]
    return df.orderBy(*keys)
