"""Pivot / unpivot with ``<metric>_<column value>`` naming.

Pivot value lists are always passed explicitly: that saves the extra job
Spark would run to discover them and bounds the output width. Never pivot on
an unbounded key (owner names, sites); pivot only on periods, flags and the
like.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def strict_pivot(df: DataFrame, index: Sequence[str], column: str, values: Sequence,
                 metrics: Sequence[str], sep: str = "_") -> DataFrame:
    """Wide table with one ``<metric><sep><value>`` column per metric and value.

    Strict like ``pandas.pivot``: an (index, value) pair seen twice fails the
    job, and so does a row whose column value is not in ``values``. Both counts
    are computed inside the same aggregate and checked in a filter, which no
    column pruning removes, so strictness costs no extra pass (R1, C5).
    Spark names multi-aggregate pivot columns ``<value>_<agg>``; they are
    renamed to the reference's ``<metric>_<value>`` order (P8).
    """
    aggs = [F.first(m, ignorenulls=False).alias(m) for m in metrics]
    aggs.append(F.count(F.lit(1)).alias("_n"))
    values = [str(v) for v in values]
    text = F.col(column).cast("string")
    slot = F.when(text.isin(values), text).otherwise(F.lit(_UNLISTED))
    wide = (df.withColumn(column, slot).groupBy(*index)
            .pivot(column, [*values, _UNLISTED]).agg(*aggs))
    checks = [F.coalesce(F.col(f"`{v}__n`"), F.lit(0)) <= 1 for v in values]
    msg = f"duplicate ({', '.join(index)}, {column}) pair in strict pivot"
    unlisted = f"{column} value outside the list of the strict pivot"
    wide = wide.where(
        F.when(F.coalesce(F.col(f"`{_UNLISTED}__n`"), F.lit(0)) > 0, F.raise_error(F.lit(unlisted)).cast("boolean"))
        .when(~_all(checks), F.raise_error(F.lit(msg)).cast("boolean")).otherwise(F.lit(True)))
    out = [F.col(c) for c in index]
    for v in values:
        for m in metrics:
            out.append(F.col(f"`{v}_{m}`").alias(f"{m}{sep}{v}"))
    return wide.select(*out)


#: Pivot column that counts rows with a value outside the list.
_UNLISTED = "__unlisted__"


def _all(conds):
    acc = F.lit(True)
    for c in conds:
        acc = acc & c
    return acc


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide -> long, NULL values kept (R4). Mixed numeric types are widened."""
    return df.unpivot(list(ids), list(values), variable, value)


def mean_pivot(df: DataFrame, index: Sequence[str], column: str, values: Sequence,
               value: str = "value") -> DataFrame:
    """``pandas.pivot_table`` with the mean.

    NULL values are dropped before grouping, which reproduces pivot_table's
    removal of index rows whose cells are all missing. A column value outside
    ``values`` fails the job, as its rows would vanish else.
    """
    listed = F.coalesce(F.col(column).isin(list(values)), F.lit(True))
    error = F.raise_error(F.lit(f"{column} value outside the list of the pivot")).cast(df.schema[column].dataType)
    return (df.where(F.col(value).isNotNull()).withColumn(column, F.when(listed, F.col(column)).otherwise(error))
            .groupBy(*index).pivot(column, list(values)).agg(F.avg(value)))


def pivot_single(df: DataFrame, index: Sequence[str], column: str, values: Sequence,
                 value: str = "value") -> DataFrame:
    """Strict pivot of one measure (R2)."""
    return strict_pivot(df, index, column, values, [value], sep="_").select(
        *index, *[F.col(f"{value}_{v}").alias(str(v)) for v in values])
