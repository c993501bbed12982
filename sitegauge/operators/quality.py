"""Data-quality queries (F4, A6, A7, V4): the reference's in-line checks as
queries that can be run, stored or asserted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.operators.aggregates import contingency, non_null_counts


def zero_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is exactly 0 (F4: sites with a zero score)."""
    return df.where(F.col(column) == 0)


def score_by_denominator(scored: DataFrame, den: str, num: str, values) -> DataFrame:
    """Counts of each score by its denominator (the in-line check of the
    service score against its denominator)."""
    return contingency(scored, den, num, values)


def wave_counts(survey: DataFrame, wave: str = "wave_id") -> DataFrame:
    """Non-NULL counts of every column per wave."""
    return non_null_counts(survey, wave)


def observe_rows(df: DataFrame, name: str):
    """Row count of ``df`` collected as a side metric of whatever action runs
    it next (S13: the reference prints shapes before and after a step).
    Returns ``(df_with_metric, observation)``; read ``observation.get``
    after the action. No extra job is run."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
