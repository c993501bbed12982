import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitegauge.plans.prices import dedupe_first, nav_link_pairs, page_texts, scraped_rows, sort_final
from sitegauge.sources.html import element_texts
from sitegauge.sources.price_log import append_log, read_price_log_csv, write_final_csv
from sitegauge.sources.schemas import VENDORS

# A small price log in the reference's CSV form: header, quoted product names
# with commas, N/A for a missing price, one repeated (product, day).
LOG = """product,apple,amazon,adorama,macmall,bestbuy,b_and_h,date
"Laptop 13in: 1.3 GHz, 512 GB - Gray",1450.00,1402.10,N/A,1460.00,1399.99,1388.00,08/26/2018
"Desktop 21in"" 2.3 GHz",899.00,N/A,N/A,N/A,879.99,860.00,08/26/2018
"Laptop 13in: 1.3 GHz, 512 GB - Gray",1450.00,1390.00,1420.00,1460.00,1399.99,1388.00,08/26/2018
"Desktop 21in"" 2.3 GHz","$1,099.00",N/A,N/A,N/A,N/A,N/A,08/27/2018
"""


def test_read_dedupe_write_golden(spark, scratch):
    path = os.path.join(scratch, "price_log.csv")
    with open(path, "w") as f:
        f.write(LOG)
    log = read_price_log_csv(spark, path)
    assert log.count() == 4
    final = dedupe_first(log.withColumnRenamed("ingest_seq", "seq").withColumn("ingest_order", F.col("seq"))
                         .withColumn("ingest_line", F.lit(0)).withColumn("ingest_supplier", F.lit(0))
                         .withColumn("ingest_amount", F.lit(0.0)))
    rows = {(r["product"], r["date"]): r for r in final.collect()}
    assert len(rows) == 3
    mb = rows[("Laptop 13in: 1.3 GHz, 512 GB - Gray", "08/26/2018")]
    assert mb["amazon"] == 1402.1 and mb["adorama"] is None        # first row kept
    assert rows[('Desktop 21in" 2.3 GHz', "08/27/2018")]["apple"] == 1099.0   # "$1,099.00" cleaned
    out = os.path.join(scratch, "final_list")
    write_final_csv(sort_final(final.select("product", *VENDORS, "date")), out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 3 and back.columns == ["product", *VENDORS, "date"]


def test_final_days_are_sorted_as_a_column(spark):
    """In the order of the parsed day, whatever way it is parsed, and parsed before the
    sort, not at every comparison; a day that is none still fails the job."""
    days = ["12/31/1999", "01/02/2000", "02/29/2000", "02/28/2000", "03/01/2000", "10/30/1999", "12/09/2001", "01/01/0001", None]
    df = spark.createDataFrame([(p, d) for p in ("b", "a", None) for d in days], "product string, date string").repartition(5)
    final = sort_final(df)
    assert final.columns == ["product", "date"]
    got = [tuple(r) for r in final.collect()]
    want = df.select("*", F.to_date("date", "MM/dd/yyyy").alias("day")).collect()
    order = lambda r: (r[0] is not None, r[0], r[2] is not None, r[2])
    assert got == [(r[0], r[1]) for r in sorted(want, key=order)]
    sorts = [x for x in final._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Sort [" in x]
    assert len(sorts) == 1 and "_day" in sorts[0] and "(" not in sorts[0].split("Sort [")[1].split("]")[0]
    for bad in ("02/30/2000", "2000-01-02", "1/2/2000", "01/02/2000\n"):
        with pytest.raises(PySparkException):
            sort_final(spark.createDataFrame([("a", bad), ("b", "01/02/2000")], "product string, date string")).collect()


HTML = ('<html><body><div class="product-name">Tab &amp; Co</div><div class="product-name">Desk</div>'
        '<div class="row cell zero x"><a href="/1">$1,299.00</a></div>'
        '<div class="cell zero"><a href="/2">N/A</a></div>'
        '<div class="cell one"><a>$9.50</a></div><div class="cell one"><a>$10</a></div>'
        '<p><b>unclosed<br></p></body></html>')


def test_class_selection_equals_and_contains(spark):
    pages = spark.createDataFrame([(1, "u", HTML)], "page_id long, url string, html string")
    r = pages.select(element_texts("html", "div", "product-name").alias("names"),
                     element_texts("html", "div", "cell zero", "contains", "a").alias("zero"),
                     element_texts("html", "div", "cell", "equals", "a").alias("none")).first()
    assert r["names"] == ["Tab & Co", "Desk"]
    assert r["zero"] == ["$1,299.00", "N/A"]
    assert r["none"] == []


def test_ordinary_html(spark):
    html = ('<!-- <div class="cell zero"><a>old</a></div> --><script>x("<div class=name>js")</script>'
            '<DIV CLASS="cell zero"><span>s</span><a>1</a> or <A href="/2">2</A></DIV>'
            '<div id=p class=name>Box&nbsp;1</div><div class=names>no</div>')
    r = spark.createDataFrame([(html,)], "html string").select(
        element_texts("html", "div", "cell zero", "contains", "a").alias("zero"),
        element_texts("html", "div", "name").alias("names")).first()
    assert r["zero"] == ["1", "2"]
    assert r["names"] == ["Box\u00a01"]


def test_zip_lists_and_run_date_stamp(spark):
    pages = spark.createDataFrame([(1, "u", HTML)], "page_id long, url string, html string")
    lists = pages.select(
        "page_id", element_texts("html", "div", "product-name").alias("product"),
        element_texts("html", "div", "cell zero", "contains", "a").alias("apple"),
        element_texts("html", "div", "cell one", "contains", "a").alias("amazon"),
        *[F.array(F.lit("N/A"), F.lit("N/A")).alias(v) for v in VENDORS[2:]])
    rows = scraped_rows(lists, dt.date(2018, 8, 26)).orderBy("pos").collect()
    assert [(r["product"], r["apple"], r["amazon"], r["date"]) for r in rows] == [
        ("Tab & Co", 1299.0, 9.5, "08/26/2018"), ("Desk", None, 10.0, "08/26/2018")]


def test_unequal_lists_fail(spark):
    pages = spark.createDataFrame([(1, "u", HTML)], "page_id long, url string, html string")
    lists = pages.select("page_id", element_texts("html", "div", "product-name").alias("product"),
                         F.array(F.lit("$1")).alias("apple"),
                         *[F.array(F.lit("$1"), F.lit("$2")).alias(v) for v in VENDORS[1:]])
    with pytest.raises(PySparkException):
        scraped_rows(lists, dt.date(2018, 8, 26)).collect()


def test_pages_table_extraction(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = page_texts(pages)
    assert texts.where("kind = 'ad'").count() == pages.count()
    links = nav_link_pairs(pages)
    assert links.count() == texts.where("kind = 'nav'").count() > 0
    assert links.where(~F.col("href").startswith("/")).count() == 0


def test_append_log_is_idempotent(spark, scratch):
    df = spark.createDataFrame([("p", 1.0, "2018-08-26")], "product string, apple double, snapshot_date string")
    path = os.path.join(scratch, "log")
    append_log(df, path)
    append_log(df, path)
    append_log(df.withColumn("snapshot_date", F.lit("2018-08-27")), path)
    assert spark.read.parquet(path).count() == 2


def test_single_quoted_class(spark):
    pages = spark.createDataFrame([(1, "u", "<div class='x cell one'><a>$3</a></div><div class=\"cell one\"><a>$4</a></div>")],
                                  "page_id long, url string, html string")
    r = pages.select(element_texts("html", "div", "cell one", "contains", "a").alias("v")).first()
    assert r["v"] == ["$3", "$4"]
