"""Price-log rows that don't parse, kept with their reasons.

The log is read permissively with the raw line of every broken record. Rules tag
rows with the reasons against them; no rule drops a row. :func:`split` gives the
rows without reasons, parsed, and the others as they were written. Counts per
reason are taken in the pass that writes either (``observe``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegauge.functions.columns import MISSING_PRICE_TOKENS, parse_money
from sitegauge.sources.schemas import PRICE_LOG_TEXT, VENDORS

RAW = "raw_line"
DAY_FORMAT = "MM/dd/yyyy"


def read_log_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The log's columns as text, and ``raw_line`` where a record has too few or too
    many fields (NULL where it is whole). ``header``: does each file begin with one?"""
    schema = T.StructType(PRICE_LOG_TEXT.fields + [T.StructField(RAW, T.StringType())])
    return (spark.read.schema(schema).option("header", header).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).csv(path))


def rules() -> dict[str, Column]:
    """Reason -> condition on a row of :func:`read_log_lines`. A broken record has
    that reason alone: its fields can't be trusted."""
    whole = F.col(RAW).isNull()
    day = F.try_to_timestamp(F.col("date"), F.lit(DAY_FORMAT))
    out = {"broken record": ~whole,
           "no product": whole & (F.coalesce(F.trim("product"), F.lit("")) == ""),
           "unreadable date": whole & day.isNull()}
    for v in VENDORS:
        written = F.coalesce(F.trim(v), F.lit(""))
        price = parse_money(v)
        out[f"unreadable price: {v}"] = whole & ~written.isin(list(MISSING_PRICE_TOKENS)) & price.isNull()
        out[f"negative price: {v}"] = whole & F.coalesce(price < 0, F.lit(False))
    return out


def tagged(lines: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
    """``lines`` with ``reasons``, an array in the rules' order (empty: none)."""
    checks = rules() if checks is None else checks
    marks = F.array(*[F.when(holds, F.lit(reason)) for reason, holds in checks.items()])
    return lines.withColumn("reasons", F.array_compact(marks))


def counted(rows: DataFrame, name: str, reasons: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``rows`` with counts of all rows, the rejected ones and each reason, taken by
    whatever action runs them."""
    seen = Observation(name)
    per = [F.count_if(F.array_contains("reasons", r)).alias(r) for r in reasons]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("reasons") > 0).alias("rejected"), *per), seen


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows parsed, rejected rows as written with their reasons). Of a broken
    record only the line is given: which field is which can't be told."""
    whole = F.col(RAW).isNull()
    good = rows.where(F.size("reasons") == 0).select("product", *[parse_money(v).alias(v) for v in VENDORS], "date")
    rejected = rows.where(F.size("reasons") > 0).select(
        *[F.when(whole, F.col(c)).alias(c) for c in ("product", *VENDORS, "date")], RAW, "reasons")
    return good, rejected
