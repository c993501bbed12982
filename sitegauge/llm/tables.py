"""Small helpers shared by the operators: reading, writing between steps, names."""

from __future__ import annotations

import uuid
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.session import ensure_checkpoint_dir

#: Stand-in ids of classes whose rows all have a null id start here, above real ids.
NULL_IDS = 1 << 62
#: Spark's switch (4.1 on) to remove a query's shuffle files as soon as it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table, through Spark's reader (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage ends there, and a lost executor loses nothing. The result's
    ``frozen_path`` lets :func:`forget` remove it.

    The written table replaces the query's shuffle files, so these are removed
    at its end: the steps of an operator don't add up on the executors' disks."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.frozen_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Remove tables that :func:`freeze` wrote and that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.frozen_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bitmap(ids: DataFrame, column: str, bits: int = 1 << 25):
    """One-hash Bloom filter of a long column, as a numpy array of words.

    It has ``bits`` bits (4 MB by default) whatever the input's size; when
    many ids fill it, it only lets more through, so callers must still join
    exactly. Its words, not the ids, reach the driver.
    """
    import numpy as np

    words = (ids.select(F.expr(f"shiftright({column} & {bits - 1}L, 6)").alias("w"),
                        F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toPandas())
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return table


def in_bitmap(table, ids):
    """For each long of ``ids``: may it be in the :func:`bitmap`?"""
    import numpy as np

    place = ids.astype(np.int64) & (len(table) * 64 - 1)
    return ((table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
