"""Join helpers.

Join strategy is left to Catalyst and AQE: with ``spark.sql.adaptive.enabled``
a side whose *measured* size is under ``autoBroadcastJoinThreshold`` is
broadcast at runtime, anything larger stays a sort-merge join, whose skewed
partitions AQE splits. No join carries a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def existence_flag(df: DataFrame, keys_df: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag`` = 1 when ``key`` occurs in ``keys_df``, else 0.

    Keys are de-duplicated first so a repeated key cannot multiply rows (D9).
    """
    marks = keys_df.select(key).distinct().withColumn("_hit", F.lit(1))
    return (df.join(marks, key, "left")
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(0)))
            .drop("_hit"))


def semi_join(df: DataFrame, keys_df: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``keys_df``."""
    return df.join(keys_df.select(key).distinct(), key, "left_semi")


def null_safe_left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join where NULL keys match NULL keys, as pandas ``merge`` does
    (trap T6). Use only where NULL keys can occur on both sides."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c)
                       for c in right.columns])
    cond = None
    for c in on:
        term = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = term if cond is None else cond & term
    return left.join(r, cond, "left").drop(*[f"_r_{c}" for c in on])


def not_equal_keep_null(col: str, value: str):
    """``col != value`` that keeps NULLs, like pandas (F9, trap T5)."""
    return ~F.col(col).eqNullSafe(F.lit(value))
