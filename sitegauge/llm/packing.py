"""Sharding by vector bin packing over bytes, tokens and rows.

Groups are the rows of equal texts. A group's vector is its share of all bytes,
tokens and rows. Groups are placed, heaviest first, into the shard where the
dot product of the vector with the shard's residual capacity is highest; a
shard whose bytes are above the even share by more than the smallest pieces
can repair is closed to further pieces.

What is placed at a time is a *piece* of bounded number:

* a group heavier than ``1 / (shards * HEAVY)`` of all bytes or rows is cut by
  row into pieces of at most that weight (so a text that a third of all rows
  repeat fills many shards evenly);
* all other groups are dealt by hash into ``LEVELS`` levels, each half as large
  as the one before, of ``PER_LEVEL`` pieces each. The last levels hold a few
  groups per piece, and their small pieces even out what larger ones left.

Only the pieces' sums reach the driver: at most ``LEVELS * PER_LEVEL`` and about
``3 * shards * HEAVY`` heavy pieces, whatever the size of the table.

Law: ``bytes`` - the shards' sizes (UTF-8 bytes of the text plus one per row)
are near equal. Slots count from 0 without gaps in every shard, in the order of
pieces and ids; they come from counts per sorted slice, never from one task.

Defined results: a null text is a group of its own with 0 bytes (size 1) and a
null checksum of 0. Null ids sort first. Repeated rows get a place each. An
empty table gives an empty result. Columns of the input are not changed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.tables import forget, freeze, read

HEAVY = 32
LEVELS = 12
PER_LEVEL = 512


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each piece (rows of shares of bytes, tokens, rows)."""
    load = np.zeros((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), dtype=int)
    order = np.lexsort((np.arange(len(vectors)), -vectors.max(axis=1)))
    rest = np.concatenate([np.cumsum(vectors[order, 0][::-1])[::-1], [0.0]])
    for i, at in enumerate(order):
        v = vectors[at]
        residual = 1 / shards - load
        gain = residual @ v
        # the remaining bytes must still be able to level this shard
        room = load[:, 0] + v[0] <= np.sort(load[:, 0])[0] + max(v[0], rest[i] / shards)
        gain = np.where(room, gain, -np.inf)
        j = int(np.argmax(gain))
        out[at] = j
        load[j] += v
    return out


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size, text_crc32, shard, slot) of every row."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = freeze(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("g1"), F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("g2"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens")), "rows")
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()
    all_bytes, all_tokens, all_rows = (max(1, int(x or 0)) for x in total)

    # Heavy groups (a bounded number) are cut by row, the others dealt by hash.
    # A row of its own weight above the bound is a piece of its own.
    most_bytes, most_rows = all_bytes / (shards * HEAVY), all_rows / (shards * HEAVY)
    groups = rows.groupBy("g1", "g2", "size").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    heavy = (groups.where((F.col("b") > most_bytes) | (F.col("n") > most_rows))
             .select("g1", "g2", "size", F.ceil(F.least(F.col("n"), F.greatest(
                 F.col("b") / most_bytes, F.col("n") / most_rows))).cast("long").alias("cuts")))
    # at most 2 * shards * HEAVY groups can be above either bound
    heavy = F.broadcast(freeze(heavy, "heavy"))
    # level l with share 2**-(l+1): zeros at the end of a hash
    mixed = F.xxhash64("g1", "g2", F.lit(1))
    level = F.least(F.expr("bit_count(((xxhash64(g1, g2, 1) & -xxhash64(g1, g2, 1)) - 1) & 1048575L)"), F.lit(LEVELS - 1))
    small = level * PER_LEVEL + F.pmod(F.shiftright(mixed, 24), F.lit(PER_LEVEL))
    cut = F.pmod(F.xxhash64("id", "g1", "g2"), F.col("cuts"))
    pieces = rows.join(heavy, ["g1", "g2", "size"], "left").select(
        "id", "size", "tokens", F.col("g2").alias("crc"),
        F.when(F.col("cuts").isNull(), small.cast("long"))
        .otherwise(F.lit(LEVELS * PER_LEVEL) + (F.xxhash64("g1", "g2", cut).bitwiseAND(F.lit((1 << 55) - 1)))).alias("piece"))
    sums = (pieces.groupBy("piece").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("n"))
            .orderBy("piece").toPandas())
    vectors = np.stack([sums["b"] / all_bytes, sums["t"] / all_tokens, sums["n"] / all_rows], axis=1).astype(float) \
        if len(sums) else np.zeros((0, 3))
    placed = spark.createDataFrame(
        list(zip(sums["piece"].tolist(), place(vectors, shards).tolist())), "piece long, shard int")
    dealt = pieces.join(F.broadcast(placed), "piece")

    # Slots: sorted slices, their counts per shard, and a row number in each.
    sliced = freeze(dealt.repartitionByRange("shard", "id", "piece", "crc").withColumn("slice", F.spark_partition_id()), "slices")
    counts = sliced.groupBy("slice", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("slice", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("slice", "shard").orderBy("id", "piece", "crc", "size")
    out = (sliced.join(first, ["slice", "shard"])
           .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                   (F.col("first") + F.row_number().over(inside) - 1).cast("long").alias("slot")))
    forget(rows)
    return out


def op2_vector_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return (shard(read(spark, sf_dir, "documents"))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
