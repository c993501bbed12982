"""Price log source and sinks.

The log is the CSV the reference appends to. Read with an explicit schema,
prices as text, then parsed with :func:`parse_money` so every missing token
becomes NULL (inference would turn a whole column into strings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.functions.columns import MISSING_PRICE_TOKENS, parse_money
from sitegauge.sources.schemas import PRICE_LOG_TEXT, VENDORS


def read_price_log_csv(spark: SparkSession, path: str,
                       null_tokens=MISSING_PRICE_TOKENS) -> DataFrame:
    """Read a price-log CSV (header, quoted commas) and tag file order."""
    return parse_prices(read_price_log_text(spark, path), null_tokens)


def read_price_log_text(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`read_price_log_csv` with their prices still as text, so that
    rows can be chosen before their prices are parsed.

    ``ingest_file`` / ``ingest_seq`` record where each row came from; within
    one file, ``monotonically_increasing_id`` follows the byte order of the
    splits, which is the file order that keep-first relies on.
    """
    raw = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
           .schema(PRICE_LOG_TEXT).csv(path))
    return raw.select(
        "product", *VENDORS, "date",
        F.col("_metadata.file_path").alias("ingest_file"),
        F.monotonically_increasing_id().alias("ingest_seq"))


def parse_prices(df: DataFrame, null_tokens=MISSING_PRICE_TOKENS) -> DataFrame:
    """Parse all six vendor columns in one projection."""
    return df.select(*[parse_money(c, null_tokens).alias(c) if c in VENDORS else F.col(c)
                       for c in df.columns])


def clean_prices(df: DataFrame) -> DataFrame:
    """Strip ``$``/``,`` from all six vendor columns and parse them, in one
    projection (X1)."""
    return df.select(*[parse_money(c).alias(c) if c in VENDORS else F.col(c)
                       for c in df.columns])


def append_log(df: DataFrame, path: str, partition_col: str = "snapshot_date") -> None:
    """Append today's rows to the log.

    Re-running a day replaces only that day's partition (dynamic partition
    overwrite), so a retry neither duplicates rows nor wipes history (D6).
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def write_final_csv(df: DataFrame, path: str) -> None:
    """Overwrite the final de-duplicated list with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
