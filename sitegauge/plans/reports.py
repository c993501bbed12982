"""Presentation and sinks of the scorecard.

The long results become the reference's wide, run-time-named columns only
here, with an explicit (bounded) slot list, never a pivot on owners or
sites. Reports are written once per dataset, in files of bounded size with an
index by (region, owner) or in one folder per pair, instead of a driver loop
writing one file per pair.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.operators.reshape import strict_pivot
from sitegauge.plans.periods import Pair
from sitegauge.plans.scorecard import (CARRIED, Scorecard, owner_region_averages,
                                       owner_vs_region_survey, region_rank)

# Names of the long measures in the wide scored table; columns are
# ``<name>_<slot>`` with slot ``yyyyt`` or ``yyyyPTDt``.
WIDE_NAMES = {
    "volume": "Volume", "premium_volume": "Premium", "loyalty_volume": "Loyalty",
    "volume_growth": "Volume_Growth", "premium_growth": "Premium_Growth",
    "penetration": "Loyalty_Pen", "penetration_points": "Loyalty_Pen_Score",
    "volume_points": "Volume_Score", "premium_points": "Premium_Score",
    "service_points": "Service_Score", "facility_points": "Facility_Score",
    "total": "Total_Score",
}
UNASSIGNED = "__unassigned__"


def slot_label(p: Pair) -> str:
    """``yyyyt`` for a closed trimester, ``yyyyPTDt`` for the open period."""
    return f"{p.year}PTD{p.trimester}" if p.is_ptd else f"{p.year}{p.trimester}"


def wide_scored(sc: Scorecard) -> DataFrame:
    """One row per roster site, one ``<name>_<slot>`` column per measure and
    scored slot (P7, P8), plus the rank of the current slot."""
    pairs = [p for p in sc.plan.pairs if p.score_ok]
    label = F.when(F.col("is_ptd"), F.concat(F.col("year").cast("string"), F.lit("PTD"),
                                             F.col("trimester").cast("string"))) \
        .otherwise(F.concat(F.col("year").cast("string"), F.col("trimester").cast("string")))
    long = sc.scored.select("site_id", label.alias("slot"),
                            *[F.col(c).alias(n) for c, n in WIDE_NAMES.items()])
    wide = strict_pivot(long, ["site_id"], "slot", [slot_label(p) for p in pairs],
                        list(WIDE_NAMES.values()))
    out = sc.sites.join(wide, "site_id", "left")
    cur = sc.plan.current
    if cur is not None:
        ranks = region_rank(sc).select("site_id", F.col("rank").alias(f"Rank_{cur.year}{cur.trimester}"))
        out = out.join(ranks, "site_id", "left")
    return out


def _partition_keys(df: DataFrame) -> DataFrame:
    """NULL region/owner go to one named partition instead of failing."""
    return (df.withColumn("region", F.coalesce(F.col("region"), F.lit(UNASSIGNED)))
            .withColumn("owner_name", F.coalesce(F.col("owner_name"), F.lit(UNASSIGNED))))


def write_scored(sc: Scorecard, root: str, run_date: dt.date) -> str:
    """The full long scored table under ``run_date=`` (Z3)."""
    path = f"{root.rstrip('/')}/scored/run_date={run_date.isoformat()}"
    extra = sc.sites.drop(*[c for c in CARRIED if c in sc.scored.columns])
    sc.scored.join(extra, "site_id", "left").write.mode("overwrite").parquet(path)
    return path


def report_frames(sc: Scorecard, assignment: DataFrame) -> dict[str, DataFrame]:
    """The three reports: the raw current-slot rows with rank, owner vs region score
    means, owner vs member/non-member survey means."""
    cur_rows = region_rank(sc).join(
        sc.scored.select("site_id", "year", "trimester", "is_ptd", "volume", "prev_volume",
                         "volume_growth", "premium_volume", "prev_premium_volume",
                         "premium_growth", "loyalty_volume", "penetration_points",
                         "service_points", "facility_points", "experience_score"),
        ["site_id", "year", "trimester", "is_ptd"], "left").join(
        sc.sites.select("site_id", "address", "city"), "site_id", "left")
    out = {
        "raw": cur_rows,
        "score_averages": owner_region_averages(sc),
        "survey_averages": owner_vs_region_survey(sc, assignment),
    }
    return {name: _partition_keys(df) for name, df in out.items()}


def _run_folder(sc: Scorecard, run_date: dt.date | None) -> str:
    """A re-run replaces the output of its own world and run date only."""
    return f"world={sc.world}" + (f"/run_date={run_date.isoformat()}" if run_date else "")


def write_reports(sc: Scorecard, assignment: DataFrame, root: str,
                  run_date: dt.date | None = None) -> dict[str, str]:
    """The reports in one folder per (region, owner) (Z4), for a handful of owners
    whose folders people open; :func:`write_report_stores` is for many."""
    root, paths = root.rstrip("/"), {}
    for name, df in report_frames(sc, assignment).items():
        path = f"{root}/{name}/{_run_folder(sc, run_date)}"
        if "site_id" in df.columns:
            # Range-partition with the site as tie-breaker: a (region, owner)
            # pair that holds a large share of all sites is split over several
            # tasks, and each task still writes few, contiguous partitions.
            df = df.repartitionByRange("region", "owner_name", "site_id")
        else:
            # few rows per owner: one file each, not one per task and owner
            df = df.repartition("region", "owner_name")
        df.write.mode("overwrite").partitionBy("region", "owner_name").parquet(path)
        paths[name] = path
    return paths


def write_report_stores(sc: Scorecard, assignment: DataFrame, root: str,
                        run_date: dt.date | None = None) -> dict[str, str]:
    """The reports in files of bounded size with an index."""
    root, paths = root.rstrip("/"), {}
    for name, df in report_frames(sc, assignment).items():
        paths[name] = f"{root}/{name}/{_run_folder(sc, run_date)}"
        write_report_store(df, paths[name])
    return paths


#: Rows of a report file at most.
REPORT_ROWS = 1_000_000
REPORT_KEYS = ("region", "owner_name")
INDEX = "_index"


def write_report_store(df: DataFrame, path: str, rows_per_file: int = REPORT_ROWS) -> None:
    """Reports in files of bounded size, with an index of which file holds which
    (region, owner) (Z4).

    Rows are range-partitioned by region, owner and all other columns: small
    owners share a file, a large one is split over tasks and files, and the number of
    files follows the data, not the number of owners. The index, a folder that
    readers of the data skip, is made from the files as written.
    """
    keys = [F.col(k) for k in REPORT_KEYS]
    rest = [F.col(c) for c in df.columns if c not in REPORT_KEYS]
    (df.repartitionByRange(*keys, *rest).sortWithinPartitions(*keys)
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path))
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    (written.groupBy(*keys, F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
     .repartitionByRange(*keys, "file").sortWithinPartitions(*keys)
     .write.mode("overwrite").parquet(f"{path}/{INDEX}"))


def report_files(spark, path: str, region: str, owner: str) -> list[str]:
    """Files that hold one report; more than one only where it is larger than a file
    or meets a file's end."""
    index = report_for(spark.read.parquet(f"{path}/{INDEX}"), region, owner)
    return sorted(r["file"] for r in index.select("file").distinct().collect())


def read_report(spark, path: str, region: str, owner: str) -> DataFrame:
    """One report's rows (F10): the index names its files, only they are opened."""
    schema = spark.read.parquet(path).schema
    files = report_files(spark, path, region, owner)
    if not files:
        return spark.createDataFrame([], schema)
    return report_for(spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in files]), region, owner)


def report_for(df: DataFrame, region: str, owner: str) -> DataFrame:
    """Ad hoc selection of one report's rows (F10): column expressions, so
    quotes in names cannot break the predicate (D17)."""
    from sitegauge.functions.columns import normalise_label
    return df.where((normalise_label("region") == normalise_label(F.lit(region)))
                    & (F.col("owner_name") == owner))
