"""Price history as a Structured Streaming job.

Each scrape run drops a file of raw rows (product, six vendor price texts,
``MM/dd/yyyy`` day, ``ingest_seq``) into a source folder. Every micro-batch:

1. appends its raw rows to the *log*, partitioned by ``batch_id``; a retried
   batch overwrites its own partition only (dynamic partition overwrite), so
   a retry neither duplicates the log nor touches history (D6);
2. keeps the first row per (product, day) inside the batch by ingest order
   (A9) and appends only keys not already in the *final* table (an anti-join
   restricted to the batch's days, which are partition values of the final
   table, so only those partitions are read). The earliest file therefore
   wins, as with the reference's append-then-keep-first, and a retried batch
   finds its rows already present and writes nothing twice.

No state store is needed: the final table itself is the set of seen keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from sitegauge.functions.columns import parse_money
from sitegauge.operators.dedupe import keep_first
from sitegauge.sources.schemas import PRICE_LOG_TEXT, VENDORS

SCRAPE_SCHEMA = T.StructType(PRICE_LOG_TEXT.fields + [T.StructField("ingest_seq", T.LongType())])
KEY = ("product", "date")
FINAL_SCHEMA = T.StructType(
    [T.StructField("product", T.StringType())]
    + [T.StructField(v, T.DoubleType()) for v in VENDORS]
    + [T.StructField("date", T.StringType()), T.StructField("day", T.StringType())])


def _day(c: str = "date") -> F.Column:
    # an unreadable date keeps its text and has no day; it never stops the stream
    return F.date_format(F.try_to_timestamp(F.col(c), F.lit("MM/dd/yyyy")), "yyyy-MM-dd")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        # Declared schema: the partition column ``day`` stays ISO text.
        return spark.read.schema(FINAL_SCHEMA).parquet(path)
    except AnalysisException:
        return None


def process_batch(batch: DataFrame, batch_id: int, log_path: str, final_path: str) -> None:
    spark = batch.sparkSession
    parsed = batch.select("product", *[parse_money(v).alias(v) for v in VENDORS], "date",
                          "ingest_seq").withColumn("day", _day()).persist()
    try:
        (parsed.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(log_path))
        firsts = keep_first(parsed, list(KEY), ["ingest_seq"], keep=[*VENDORS, "day"])
        seen = _existing(spark, final_path)
        if seen is not None:
            # A scrape batch covers a handful of days: filter the final table
            # on its partition column so only those days are listed and read.
            days = [r[0] for r in parsed.select("day").distinct().collect()]
            on_days = F.col("day").isin([d for d in days if d is not None])
            if None in days:
                on_days = F.coalesce(on_days, F.lit(True)) | F.col("day").isNull()
            seen = seen.where(on_days).select(*[F.col(c).alias(f"seen_{c}") for c in (*KEY, "day")])
            # null-safe, as keep-first treats missing keys as equal
            same = [F.col(c).eqNullSafe(F.col(f"seen_{c}")) for c in (*KEY, "day")]
            firsts = firsts.join(seen, same, "left_anti")
        firsts.select("product", *VENDORS, "date", "day").write.mode("append") \
            .partitionBy("day").parquet(final_path)
    finally:
        parsed.unpersist()


def start(spark: SparkSession, source_dir: str, log_path: str, final_path: str,
          checkpoint: str, available_now: bool = True,
          max_files_per_trigger: int | None = None, source_format: str = "parquet") -> StreamingQuery:
    """Start the job; ``checkpoint`` must be on shared storage on a cluster.
    Scrape drops are Parquet, or CSV with a header (``source_format="csv"``);
    either way they are read with the declared scrape schema."""
    reader = spark.readStream.schema(SCRAPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if source_format == "csv":
        stream = (reader.option("header", True).option("quote", '"').option("escape", '"')
                  .csv(source_dir))
    elif source_format == "parquet":
        stream = reader.parquet(source_dir)
    else:
        raise ValueError(f"source_format must be 'parquet' or 'csv', not {source_format!r}")
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: process_batch(df, bid, log_path, final_path))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
