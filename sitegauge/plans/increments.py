"""Period totals kept up to date part by part.

Facts lie in a store of monthly or daily parts (:mod:`sitegauge.sources.fact_store`).
For each part, sums per site and month are kept in ``partials`` (exact decimals,
so partial sums add up to the same totals bit for bit), and ``ledger`` says from
which state of the part they were made. A run compares the parts' fingerprints
with the ledger, reads only parts that are new or were corrected, replaces
their sums, and then writes the ledger: a run that fails in between does those
parts again. Sums of parts that have gone are left out by the ledger.

The ledger has one small file per run and as many rows as parts were touched;
the list of touched parts on the driver is bounded by the calendar. One writer at
a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sitegauge.functions.calendar import ReportingCalendar
from sitegauge.plans.periods import (LOYALTY, VOLUME, data_window, period_totals, present_months, roster_months)
from sitegauge.session import freeze
from sitegauge.sources.fact_store import part_states, read_facts

#: Stored columns of each fact, without the part.
FACTS = {VOLUME: "site_id string, volume decimal(18,2), premium_volume decimal(18,2), day date",
         LOYALTY: "site_id string, loyalty_volume decimal(22,4), day date"}
MEASURES = {"volume": "decimal(18,2)", "premium_volume": "decimal(18,2)", "loyalty_volume": "decimal(22,4)"}
PARTIALS = ("site_id string, year int, month int, volume decimal(28,2), premium_volume decimal(28,2), "
            "loyalty_volume decimal(32,4), n_rows long, source string, part string")
LEDGER = "source string, part string, fingerprint string, run long"


def ledger(spark: SparkSession, state: str) -> DataFrame:
    """The last entry of each (source, part); its fingerprint is NULL once the part has gone."""
    try:
        entries = spark.read.schema(LEDGER).parquet(f"{state}/ledger")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        entries = spark.createDataFrame([], LEDGER)
    return entries.groupBy("source", "part").agg(F.max_by("fingerprint", "run").alias("fingerprint"), F.max("run").alias("run"))


def changed_parts(spark: SparkSession, store: str, state: str, source: str) -> tuple[dict, int]:
    """(part -> fingerprint of parts that are new, corrected or gone (None), next run's number)."""
    seen = ledger(spark, state)
    run = (seen.agg(F.max("run")).first()[0] or 0) + 1
    now = part_states(spark, store).select("part", F.col("fingerprint").alias("now"))
    was = seen.where(F.col("source") == source).select("part", F.col("fingerprint").alias("was"))
    apart = now.join(was, "part", "full_outer").where(~F.col("now").eqNullSafe(F.col("was")))
    return {r["part"]: r["now"] for r in apart.collect()}, run


def refresh(spark: SparkSession, store: str, state: str, source: str) -> list[str]:
    """Bring the sums of one fact up to date; the parts that were touched."""
    state = state.rstrip("/")
    parts, run = changed_parts(spark, store, state, source)
    if not parts:
        return []
    new = sorted(p for p, now in parts.items() if now is not None)
    if new:
        rows = read_facts(spark, store, FACTS[source]).where(F.col("part").isin(new))
        sums = rows.groupBy("part", "site_id", F.year("day").alias("year"), F.month("day").alias("month")).agg(
            *[(F.sum(m) if m in rows.columns else F.sum(F.lit(None).cast(t))).alias(m) for m, t in MEASURES.items()],
            F.count(F.lit(1)).alias("n_rows")).withColumn("source", F.lit(source))
        (sums.hint("rebalance", F.col("part")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("source", "part").parquet(f"{state}/partials"))
    (spark.createDataFrame([(source, p, now, run) for p, now in sorted(parts.items())], LEDGER)
     .coalesce(1).write.mode("append").parquet(f"{state}/ledger"))
    return sorted(parts)


def monthly_sums(spark: SparkSession, state: str, roster: DataFrame, calendar: ReportingCalendar) -> DataFrame:
    """Sums per (site, year, month, source), as ``monthly_facts`` gives them, from the
    kept sums: no fact row is read."""
    state = state.rstrip("/")
    live = ledger(spark, state).where(F.col("fingerprint").isNotNull()).select("source", "part")

    def since(source: str, day: dt.date):
        # the scan bounds begin a year; parts are texts of dates, so earlier ones are pruned
        return (F.col("source") == source) & (F.col("part") >= f"{day.year:04d}")

    kept = (spark.read.schema(PARTIALS).parquet(f"{state}/partials")
            .where(since(VOLUME, calendar.volume_start) | since(LOYALTY, calendar.loyalty_start))
            .join(live, ["source", "part"], "left_semi"))
    monthly = kept.groupBy("site_id", "year", "month", "source").agg(
        *[F.sum(m).alias(m) for m in MEASURES], F.sum("n_rows").alias("n_rows"))
    return roster_months(monthly, roster)


def incremental_totals(spark: SparkSession, state: str, roster: DataFrame, calendar: ReportingCalendar) -> DataFrame | None:
    """Period totals (C6, C7) from the kept sums; None without any fact."""
    monthly = freeze(monthly_sums(spark, state, roster, calendar), "monthly-sums")
    window = data_window(present_months(monthly))
    return None if window is None else period_totals(monthly, window)
