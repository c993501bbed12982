"""Price-history job.

Scrape step: a table of pages is read once and all selections are answered in
one walk over each page's tokens, inside one projection. Log step: money text is
cleaned in one projection, the day's rows are appended, and the log is
de-duplicated keeping the first row per (product, day) in ingest order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.functions.columns import parse_money, us_date_text
from sitegauge.operators.dedupe import keep_first_late
from sitegauge.sources.html import Selection, select_lists, zip_lists
from sitegauge.sources.price_log import clean_prices
from sitegauge.sources.schemas import VENDORS
from sitegauge.sources.standins import PRICE_INGEST_ORDER, price_log_records

LOG_KEY = ("product", "date")

# The price-comparison page's selections. Product names are the
# text of elements whose class equals PRODUCT_CLASS; each vendor's price is
# the text of the <a> inside elements whose class contains its cell class.
PRODUCT_CLASS = "product-name"
VENDOR_CELL_CLASSES = {
    "apple": "cell zero",
    "amazon": "cell one",
    "adorama": "cell two",
    "macmall": "cell three",
    "bestbuy": "cell four",
    "b_and_h": "cell five",
}

# Which page parts are extracted, by kind.
PAGE_SELECTIONS = {
    "ad": Selection("div", "class", "ad"),
    "nav": Selection("li", child="a"),
    "heading": Selection("h1"),
}
# Parts found by what an attribute contains, and parts whose
# elements the pages don't close.
PAGE_CONTAINS = {
    "part_of_class": Selection("div", "class", "a", "contains"),
    "link": Selection("a", "href", "th", "contains"),
    "target": Selection("a", "href", "th", "contains", take="href"),
    "item_link": Selection("li", child="a", take="href"),
}
PAGE_BODY = {
    "paragraph": Selection("p"),
    "bold": Selection("b"),
    "bold_in_paragraph": Selection("p", child="b"),
    "footer": Selection("footer"),
    "article": Selection("article"),
}


def scrape_lists(pages: DataFrame, wanted: dict[str, Selection] = PAGE_SELECTIONS) -> DataFrame:
    """One array column per selection, all from one walk over ``html``."""
    return select_lists(pages, ["page_id"], wanted)


def page_texts(pages: DataFrame, wanted: dict[str, Selection] = PAGE_SELECTIONS) -> DataFrame:
    """Selected texts, one row per (page, kind, position)."""
    lists = scrape_lists(pages, wanted)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("texts")) for k in wanted])
    per_kind = lists.select("page_id", F.explode(kinds).alias("k"))
    return per_kind.select("page_id", F.col("k.kind").alias("kind"),
                           F.posexplode("k.texts").alias("pos", "text")).select(
        "page_id", "kind", F.col("pos").cast("long").alias("pos"), "text")


def nav_link_pairs(pages: DataFrame) -> DataFrame:
    """Link texts and link targets of the navigation list, zipped by
    position (S4); lists of different length fail the job."""
    lists = select_lists(pages, ["page_id"], {"text": Selection("li", child="a"), "href": Selection("li", child="a", take="href")})
    return zip_lists(lists, ["page_id"], ["text", "href"])


def scraped_rows(products: DataFrame, run_date: dt.date) -> DataFrame:
    """Zip parallel product/vendor lists into rows, stamp the run date, clean
    money (S4, P13, X1). ``products`` has array columns ``product`` and one
    per vendor."""
    rows = zip_lists(products, ["page_id"], ["product", *VENDORS])
    stamped = rows.withColumn("date", us_date_text(F.lit(run_date)))
    return clean_prices(stamped)


def product_lists(pages: DataFrame) -> DataFrame:
    """Product names and the six vendor price lists of each comparison page,
    all from one walk over the page (S2, S3)."""
    return select_lists(pages, ["page_id"], {
        "product": Selection("div", "class", PRODUCT_CLASS),
        **{v: Selection("div", "class", cls, "contains", child="a") for v, cls in VENDOR_CELL_CLASSES.items()}})


def scrape_prices(pages: DataFrame, run_date: dt.date) -> DataFrame:
    """One cleaned row per product and page for ``run_date``, with the ingest
    order (page, position) kept for keep-first."""
    return scraped_rows(product_lists(pages), run_date)


def cleaned_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in price log, money parsed, ingest order kept."""
    raw = price_log_records(spark, sf_dir)
    return raw.select(
        "product", *[parse_money(v).alias(v) for v in VENDORS], "date",
        *PRICE_INGEST_ORDER)


def dedupe_first(log: DataFrame) -> DataFrame:
    """First row per (product, day) in ingest order (A9). The key is the text
    day as written, like the reference. Most days list a product once, so only
    repeated keys are resolved; the other rows, prices included, never move."""
    return keep_first_late(log, list(LOG_KEY), list(PRICE_INGEST_ORDER),
                           keep=["product", *VENDORS, "date"])


#: Text days of four-digit years whose day every month has.
PLAIN_DAY = r"^(0[1-9]|1[0-2])/(0[1-9]|1[0-9]|2[0-8])/(?!0000)[0-9]{4}\z"


def text_day(c: str) -> Column:
    """``to_date(c, "MM/dd/yyyy")``. Parsing is dear: plain days are put together from
    their digits, and only the others are parsed."""
    month, day, year = (F.substring(c, at, n).try_cast("int") for at, n in ((1, 2), (4, 2), (7, 4)))
    return F.when(F.col(c).rlike(PLAIN_DAY), F.make_date(year, month, day)).otherwise(F.to_date(c, "MM/dd/yyyy"))


def sort_final(df: DataFrame) -> DataFrame:
    """Optional chronological order (O2, T13): text days do not sort across
    years, so the sort uses the parsed date, as a column: an expression would be
    evaluated at every comparison."""
    return df.withColumn("_day", text_day("date")).orderBy("product", "_day").drop("_day")
