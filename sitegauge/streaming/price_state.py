"""Keep-first of the price history in a state store.

Two streaming queries read the scrape drops, each exactly once (its own
checkpoint, and Spark's file sink, which skips a batch that it has written):

* the *log* keeps every row as parsed, partitioned by day;
* the *final* list groups rows by (product, date). The state store holds, per
  key of an open day, the row with the smallest ``ingest_seq``, so neither the
  final table nor the log is read again. A day closes, and its rows are written
  once, when a row has come whose day is at least ``delay`` later (the watermark
  on the day); the state of closed days is dropped, so it is bounded by the open
  days' products.

Within ``delay`` the order in which drops come doesn't matter. Rows that come
after their day was closed, and rows without a readable day, are in the log only:
:func:`late_rows` finds them, and :func:`current_list` gives the list with them
and with the open days, equal to a batch over all rows at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sitegauge.functions.columns import parse_money
from sitegauge.operators.dedupe import keep_first
from sitegauge.sources.schemas import VENDORS
from sitegauge.streaming.price_history import KEY, SCRAPE_SCHEMA

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: A state store on disk, whose size isn't bound by the executors' memory.
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_FORMAT = "MM/dd/yyyy"

ROWS = T.StructType(
    [T.StructField("product", T.StringType())] + [T.StructField(v, T.DoubleType()) for v in VENDORS]
    + [T.StructField("date", T.StringType()), T.StructField("ingest_seq", T.LongType()), T.StructField("day", T.StringType())])


def scrape_stream(spark: SparkSession, source_dir: str, source_format: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The drops as parsed rows, with their day (NULL where it can't be read)."""
    reader = spark.readStream.schema(SCRAPE_SCHEMA).format(source_format)
    if source_format == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    day = F.date_format(F.try_to_timestamp(F.col("date"), F.lit(DAY_FORMAT)), "yyyy-MM-dd")
    return reader.load(source_dir).select(
        "product", *[parse_money(v).alias(v) for v in VENDORS], "date", "ingest_seq").withColumn("day", day)


def closed_firsts(rows: DataFrame, delay: str) -> DataFrame:
    """First row of each (product, date) of closed days, by a stateful aggregate."""
    dated = rows.where(F.col("day").isNotNull()).withColumn("closes", F.to_timestamp("day", "yyyy-MM-dd"))
    payload = F.struct(*VENDORS, "ingest_seq")
    return (dated.withWatermark("closes", delay)
            .groupBy(*KEY, "day", "closes").agg(F.min_by(payload, F.struct("ingest_seq", *VENDORS)).alias("first"))
            .select("product", *[F.col(f"first.{v}").alias(v) for v in VENDORS], "date",
                    F.col("first.ingest_seq").alias("ingest_seq"), "day"))


def start(spark: SparkSession, source_dir: str, out: str, checkpoint: str, delay: str = "2 days",
          available_now: bool = True, max_files_per_trigger: int | None = None,
          source_format: str = "parquet") -> dict[str, StreamingQuery]:
    """Start both queries; ``out`` and ``checkpoint`` must be on shared storage on a
    cluster. The state store is the session's, or one on disk if none is set."""
    if spark.conf.get(STATE_STORE, "").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, ON_DISK)
    rows = scrape_stream(spark, source_dir, source_format, max_files_per_trigger)
    queries = {}
    for name, frame in (("log", rows), ("final", closed_firsts(rows, delay))):
        writer = (frame.writeStream.format("parquet").outputMode("append").partitionBy("day").queryName(f"prices-{name}")
                  .option("path", f"{out.rstrip('/')}/{name}").option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}"))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
        queries[name] = writer.start()
    return queries


def read_rows(spark: SparkSession, out: str, name: str) -> DataFrame:
    """``log`` or ``final`` as written so far."""
    return spark.read.schema(ROWS).parquet(f"{out.rstrip('/')}/{name}")


def late_rows(log: DataFrame, final: DataFrame) -> DataFrame:
    """Rows of the log that the final list doesn't answer for: of a key that it
    lacks (open or unreadable days, products that came after their day was closed),
    or before the row that it kept."""
    kept = final.select(*[F.col(c).alias(f"kept_{c}") for c in (*KEY, "day", "ingest_seq")])
    same = [F.col(c).eqNullSafe(F.col(f"kept_{c}")) for c in (*KEY, "day")]
    return log.join(kept, [*same, F.col("kept_ingest_seq") <= F.col("ingest_seq")], "left_anti")


def current_list(log: DataFrame, final: DataFrame) -> DataFrame:
    """(product, vendors, date, ingest_seq, day): the first row of every key in the log."""
    every = final.unionByName(late_rows(log, final))
    return keep_first(every, list(KEY), ["ingest_seq", *VENDORS], keep=[*VENDORS, "ingest_seq", "day"]).select(
        "product", *VENDORS, "date", "ingest_seq", "day")
