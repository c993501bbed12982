"""The driver's TPC-H-style tables cast in the scorecard's roles.

Two "worlds" are built from the same tables, each a complete set of job
inputs (roster, location hierarchy, survey files in two layouts, daily volume
records, loyalty records with a nested parent key, region assignment):

* ``customer_world``: sites are customers; volume and loyalty come from
  ``orders`` (data ends in August, so the window's branch depends on the data).
* ``supplier_world``: sites are suppliers; volume and loyalty come from
  ``lineitem`` (data ends in November: an open period at every scale).

Every role is a projection/aggregate of the full tables, so its size grows
with the data. The same definitions are written in SQL in
``sitegauge.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.functions.calendar import trimester
from sitegauge.sources.schemas import QUESTIONS

# Fixed values of the stand-in mapping.
PREMIUM_PRIORITIES = ("1-URGENT", "2-HIGH")
LOYALTY_SHARE = "0.15"
ANSWER_CODES = ("Yes", "Caution", "No")      # code 3 -> missing answer
# Survey answers come from a Lehmer (MINSTD) step on a per-row seed: the
# product stays below 2^47, so no 64-bit overflow at any key size.
HASH_MULTIPLIER = 48271
HASH_MODULUS = 2147483647
SKIPPED_REGION_NAME = "ASIA"
SKIP_MARK = "SKIP FOR NOW"
UNASSIGNED_NATION_KEY = 0

CUSTOMER_RUN_DATE = dt.date(2001, 9, 10)
SUPPLIER_RUN_DATE = dt.date(2001, 12, 10)


@dataclass
class World:
    name: str
    run_date: dt.date
    roster: DataFrame
    hierarchy: DataFrame
    volume_records: DataFrame      # site_id, ts, volume, premium_volume (record level)
    loyalty_records: DataFrame     # location_master{location_number}, ts, loyalty_volume
    survey_files: Sequence[DataFrame]  # legacy layout, current layout
    assignment: DataFrame          # territory_manager, region


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read with its declared schema (no inference job)."""
    from sitegauge.sources.schemas import DRIVER_TABLES
    reader = spark.read
    if name in DRIVER_TABLES:
        reader = reader.schema(DRIVER_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _answer(h: Column, k: int) -> Column:
    code = F.shiftright(h, 2 * k) % 4
    out = F.lit(None).cast("string")
    expr = F.when(code == 0, F.lit(ANSWER_CODES[0]))
    for i, a in enumerate(ANSWER_CODES[1:], start=1):
        expr = expr.when(code == i, F.lit(a))
    return expr.otherwise(out)


def _survey_rows(seeds: DataFrame, managers: DataFrame) -> DataFrame:
    """seeds: (site_id, wave_id, seed) -> canonical survey rows."""
    h = ((F.col("seed") % F.lit(HASH_MODULUS)) * F.lit(HASH_MULTIPLIER)) % F.lit(HASH_MODULUS)
    return seeds.join(managers, "site_id", "left").select(
        "site_id", "wave_id", "territory_manager", "sales_manager",
        *[_answer(h, k).alias(q.lower()) for k, q in enumerate(QUESTIONS)],
        (h % 101).cast("double").alias("experience_score"))


def _survey_files(survey: DataFrame, split_year: int) -> list[DataFrame]:
    """Render canonical survey rows as two files: waves before ``split_year``
    in the legacy layout (numeric ids, ``LocationCode``, ``_Response``
    suffixes, Q15/Q19), later waves in the current layout."""
    year = F.substring("wave_id", 1, 4).cast("int")
    legacy_name = {"q14": "Q15", "q18": "Q19"}
    legacy = survey.where(year < split_year).select(
        F.col("site_id").cast("long").alias("LocationCode"),
        F.col("wave_id").cast("long").alias("WavId"),
        F.col("territory_manager").alias("Territory Manager"),
        F.col("sales_manager").alias("Sales Manager"),
        *[F.col(q.lower()).alias(f"{legacy_name.get(q.lower(), q)}_Response") for q in QUESTIONS],
        F.col("experience_score").alias("SEScore"))
    current = survey.where(year >= split_year).select(
        F.col("site_id").alias("LOCATION#"),
        F.col("wave_id").alias("WAVID"),
        F.col("territory_manager").alias("TERRITORY MANAGER"),
        F.col("sales_manager").alias("SALES MANAGER"),
        *[F.col(q.lower()).alias(q) for q in QUESTIONS],
        F.col("experience_score").alias("SESCORE"))
    return [legacy, current]


class SurveyFiles:
    """The survey as two layout files, rendered on first use from one
    materialised canonical survey: the fact table is aggregated once for
    both files instead of once per file."""

    def __init__(self, survey: DataFrame, split_year: int):
        self._survey, self._split_year, self._files = survey, split_year, None

    def _render(self) -> list[DataFrame]:
        if self._files is None:
            from sitegauge.session import freeze
            self._files = _survey_files(freeze(self._survey, "standin-survey"),
                                        self._split_year)
        return self._files

    def once(self) -> list[DataFrame]:
        """The files for a reader that writes them itself: not materialised before,
        each aggregates its own waves."""
        return self._files or _survey_files(self._survey, self._split_year)

    def __iter__(self):
        return iter(self._render())

    def __len__(self) -> int:
        return len(self._render())

    def __getitem__(self, i: int) -> DataFrame:
        return self._render()[i]


def _assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (nation.where(F.col("n_nationkey") != UNASSIGNED_NATION_KEY)
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("territory_manager"),
                    F.when(F.col("r_name") == SKIPPED_REGION_NAME, F.lit(SKIP_MARK))
                    .otherwise(F.col("r_name")).alias("region")))


def _wave(ts: str) -> Column:
    return F.concat(F.year(ts).cast("string"), trimester(F.month(ts)).cast("string"))


def customer_world(spark: SparkSession, sf_dir: str) -> World:
    customer = table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    orders = table(spark, sf_dir, "orders")
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    site = F.col("c_custkey").cast("string").alias("site_id")

    cust_geo = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    roster = cust_geo.where(F.col("c_acctbal") >= 0).select(
        site, F.col("r_name").alias("region"), F.col("n_name").alias("district"))
    hierarchy = cust_geo.select(
        site, F.col("c_mktsegment").alias("owner_name"),
        F.col("c_nationkey").cast("string").alias("owner_number"),
        F.col("c_name").alias("address"), F.col("n_name").alias("city"))
    volume = orders.select(
        F.col("o_custkey").cast("string").alias("site_id"),
        F.col("o_orderdate").alias("ts"),
        _money("o_totalprice").alias("volume"),
        F.when(F.col("o_orderpriority").isin(*PREMIUM_PRIORITIES), _money("o_totalprice"))
        .otherwise(F.lit(0).cast("decimal(18,2)")).alias("premium_volume"))
    loyalty = orders.where(F.col("o_orderstatus") == "F").select(
        F.struct(F.col("o_custkey").cast("string").alias("location_number"))
        .alias("location_master"),
        F.col("o_orderdate").alias("ts"),
        (_money("o_totalprice") * F.lit(LOYALTY_SHARE).cast("decimal(3,2)"))
        .alias("loyalty_volume"))
    seeds = (orders.groupBy(F.col("o_custkey").cast("string").alias("site_id"),
                            _wave("o_orderdate").alias("wave_id"))
             .agg(F.min("o_orderkey").alias("seed")))
    managers = cust_geo.select(site, F.col("n_name").alias("territory_manager"),
                               F.col("r_name").alias("sales_manager"))
    survey = _survey_rows(seeds, managers)
    return World("customer", CUSTOMER_RUN_DATE, roster, hierarchy, volume, loyalty,
                 SurveyFiles(survey, CUSTOMER_RUN_DATE.year), _assignment(spark, sf_dir))


def supplier_world(spark: SparkSession, sf_dir: str) -> World:
    supplier = table(spark, sf_dir, "supplier")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    lineitem = table(spark, sf_dir, "lineitem")
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    site = F.col("s_suppkey").cast("string").alias("site_id")

    supp_geo = supplier.join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
    roster = supp_geo.where(F.col("s_acctbal") >= 0).select(
        site, F.col("r_name").alias("region"), F.col("n_name").alias("district"))
    hierarchy = supp_geo.select(
        site, F.col("n_name").alias("owner_name"),
        F.col("s_nationkey").cast("string").alias("owner_number"),
        F.col("s_name").alias("address"), F.col("n_name").alias("city"))
    volume = lineitem.select(
        F.col("l_suppkey").cast("string").alias("site_id"),
        F.col("l_shipdate").alias("ts"),
        _money("l_extendedprice").alias("volume"),
        F.when(F.col("l_returnflag") == "R", _money("l_extendedprice"))
        .otherwise(F.lit(0).cast("decimal(18,2)")).alias("premium_volume"))
    loyalty = lineitem.where(F.col("l_linestatus") == "F").select(
        F.struct(F.col("l_suppkey").cast("string").alias("location_number"))
        .alias("location_master"),
        F.col("l_shipdate").alias("ts"),
        (_money("l_extendedprice") * F.lit(LOYALTY_SHARE).cast("decimal(3,2)"))
        .alias("loyalty_volume"))
    seeds = (lineitem.groupBy(F.col("l_suppkey").cast("string").alias("site_id"),
                              _wave("l_shipdate").alias("wave_id"))
             .agg(F.min(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seed")))
    managers = supp_geo.select(site, F.col("n_name").alias("territory_manager"),
                               F.col("r_name").alias("sales_manager"))
    survey = _survey_rows(seeds, managers)
    return World("supplier", SUPPLIER_RUN_DATE, roster, hierarchy, volume, loyalty,
                 SurveyFiles(survey, SUPPLIER_RUN_DATE.year), _assignment(spark, sf_dir))


def price_log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price-log rows as scraped text, one per ``lineitem`` row.

    product = part key, day = ship date as ``MM/dd/yyyy``, the price sits in
    vendor column ``l_suppkey % 6`` as ``$1,234.50`` and the other five hold
    ``N/A``. ``ingest_*`` columns give the keep-first order.
    """
    return price_log_text(price_log_source(spark, sf_dir))


def price_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a price-log row is made of, in the table's own compact types, for steps
    that move rows before their text is needed."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_shipdate").alias("day"),
        F.col("l_orderkey").alias("ingest_order"),
        F.col("l_linenumber").alias("ingest_line"),
        F.col("l_suppkey").alias("ingest_supplier"),
        F.col("l_extendedprice").alias("ingest_amount"))


def price_log_text(source: DataFrame) -> DataFrame:
    """Rows of :func:`price_log_source` as scraped text."""
    from sitegauge.sources.schemas import VENDORS
    price = F.concat(F.lit("$"), F.format_number(F.col("ingest_amount"), 2))
    slot = F.col("ingest_supplier") % len(VENDORS)
    return source.select(
        F.col("part").cast("string").alias("product"),
        *[F.when(slot == i, price).otherwise(F.lit("N/A")).alias(v)
          for i, v in enumerate(VENDORS)],
        F.date_format("day", "MM/dd/yyyy").alias("date"),
        "ingest_order", "ingest_line", "ingest_supplier", "ingest_amount")


PRICE_INGEST_ORDER = ("ingest_order", "ingest_line", "ingest_supplier", "ingest_amount")
