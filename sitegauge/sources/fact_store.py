"""A fact table laid out by date.

Facts lie in one folder for each month or day (``part=1998-07``, or
``part=1998-07-31``), a correction replaces its part. What is asked of a part's
being there, its age or its last day is answered from file names and Parquet
footers, without reading rows.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text of a part for each unit.
UNITS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}


def write_facts(facts: DataFrame, root: str, unit: str = "month", ts_col: str = "ts") -> None:
    """Write facts (with a time column) into their parts, replacing those parts and
    no other. A part of any size is written by as many tasks as it has rows for: the
    shuffle may split it."""
    rows = facts.withColumn("day", F.to_date(ts_col)).drop(ts_col)
    rows = rows.withColumn("part", F.date_format("day", UNITS[unit]))
    # a rebalance keeps parts together, but splits those over the advisory size
    (rows.hint("rebalance", F.col("part")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("part").parquet(root))


def read_facts(spark: SparkSession, root: str, schema) -> DataFrame:
    """The store's rows with their ``part`` as text; ``schema`` is the facts' without it."""
    return spark.read.schema(f"{schema}, part string").parquet(root)


def part_states(spark: SparkSession, root: str) -> DataFrame:
    """(part, fingerprint, bytes) of every part, from the list of its files: names,
    sizes and times. A part that is written again has another fingerprint."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(root).select("path", "length", "modificationTime"))
    part = F.regexp_extract("path", r"/part=([^/]*)/", 1)
    one = F.concat_ws(" ", F.regexp_extract("path", r"([^/]*)$", 1), "length", F.unix_micros("modificationTime"))
    # sums of file hashes combine in any order
    return files.groupBy(part.alias("part")).agg(
        F.md5(F.concat_ws(" ", F.sum(F.xxhash64(one).cast("decimal(20,0)")), F.count(F.lit(1)))).alias("fingerprint"),
        F.sum("length").alias("bytes"))


@contextmanager
def footer_aggregates(spark: SparkSession):
    """Within this, plain minima, maxima and counts over Parquet are pushed into the
    scan and answered from file footers."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def last_day(spark: SparkSession, root: str) -> DataFrame:
    """One row, the store's last ``day``; plan and run it within :func:`footer_aggregates`."""
    # the footers' columns are found by their place, so the files' own schema is read
    return spark.read.parquet(root).agg(F.max("day").alias("day"))


def latest_month(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """(year, month) of the store's last day (A5), without reading rows; None if it has none."""
    with footer_aggregates(spark):
        day = last_day(spark, root).first()["day"]
    return None if day is None else (day.year, day.month)


def write_bucketed(rows: DataFrame, table: str, path: str, buckets: int, key: str = "site_id", part: str | None = None) -> DataFrame:
    """Store ``rows`` as an external table under ``path``, dealt into ``buckets`` by
    ``key`` and sorted by it, in parts by the column ``part`` if given. Tables with
    the same buckets meet, and are grouped by ``key``, without a shuffle."""
    # one file for each bucket and part, not for each task besides
    dealt = rows.repartition(buckets, key)
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(part) if part else writer).saveAsTable(table)
    return rows.sparkSession.table(table)
