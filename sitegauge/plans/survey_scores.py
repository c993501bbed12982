"""Survey ratios (C1, C2): per survey row, column arithmetic only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.functions.columns import ieee_ratio

# Fixed values of the scoring rule.
FULL_DENOMINATOR = 21
MAIN_POINTS = {"Yes": 6, "Caution": 3}    # per main question
MAIN_WEIGHT = 6                           # denominator share of a main question
EXTRA_YES_POINTS = 3                      # last question, "Yes" only
EXTRA_WEIGHT = 3
SERVICE_MAIN, SERVICE_EXTRA = ("q10", "q11", "q12"), "q18"
FACILITY_MAIN, FACILITY_EXTRA = ("q7", "q8", "q9"), "q14"


def _points(q: str) -> Column:
    c = F.col(q)
    out = F.lit(0)
    for answer, pts in reversed(list(MAIN_POINTS.items())):
        out = F.when(c == answer, F.lit(pts)).otherwise(out)
    return out


def _score(main, extra, extra_counts_in_den: bool):
    num = F.lit(0)
    den = F.lit(FULL_DENOMINATOR)
    for q in main:
        num = num + _points(q)
        den = den - F.when(F.col(q).isNull(), F.lit(MAIN_WEIGHT)).otherwise(F.lit(0))
    num = num + F.when(F.col(extra) == "Yes", F.lit(EXTRA_YES_POINTS)).otherwise(F.lit(0))
    if extra_counts_in_den:
        den = den - F.when(F.col(extra).isNull(), F.lit(EXTRA_WEIGHT)).otherwise(F.lit(0))
    return num, den


def survey_ratios(survey: DataFrame) -> DataFrame:
    """Add service and facility numerators, denominators and ratios.

    Service (C1): a missing last question (Q18) does not reduce the
    denominator. Facility (C2): a missing Q14 does, so all four missing gives
    0/0, a NULL ratio (D12 kept as computed). Matching is exact and
    case-sensitive; any other answer scores 0.
    """
    s_num, s_den = _score(SERVICE_MAIN, SERVICE_EXTRA, extra_counts_in_den=False)
    f_num, f_den = _score(FACILITY_MAIN, FACILITY_EXTRA, extra_counts_in_den=True)
    return (survey
            .withColumn("service_num", s_num.cast("long"))
            .withColumn("service_den", s_den.cast("long"))
            .withColumn("facility_num", f_num.cast("long"))
            .withColumn("facility_den", f_den.cast("long"))
            .withColumn("service_ratio", ieee_ratio("service_num", "service_den"))
            .withColumn("facility_ratio", ieee_ratio("facility_num", "facility_den")))


SURVEY_METRICS = ("service_ratio", "facility_ratio", "experience_score")
# Short labels for wide ``<label>_<wave>`` columns (no underscore inside, so a
# split on "_" recovers label and wave).
WIDE_LABELS = {"service_ratio": "service", "facility_ratio": "facility",
               "experience_score": "experience"}
