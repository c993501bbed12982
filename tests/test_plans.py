"""Plan shape checks: pushdown, pruning, no Python in the hot path,
map-side combine before every shuffle of raw facts."""

import datetime as dt
import re

from pyspark.sql import functions as F

from conftest import SF001
from sitegauge.operators.quality import observe_rows
from sitegauge.operators.reshape import pivot_single
from sitegauge.plans import scorecard as sc
from sitegauge.plans.periods import at_or_after
from sitegauge.plans.reports import report_for
from sitegauge.registry import QUERIES
from sitegauge.sources.snapshot import read_or_build_snapshot
from sitegauge.sources.standins import customer_world, price_log_records


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_bound_is_pushed_to_parquet(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    df = orders.where(at_or_after(orders, "o_orderdate", dt.date(1999, 1, 1))).select("o_custkey")
    text = plan_text(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate," in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_scorecard_has_no_python_udf(spark):
    card = sc.build_scorecard(customer_world(spark, SF001))
    for df in (card.scored, sc.member_vs_other(card, customer_world(spark, SF001).assignment)):
        text = plan_text(df)
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_late_keep_first_moves_no_wide_rows(spark):
    """Keys are counted by a hash aggregate; rows whose key is their own pass
    without a shuffle, and nothing sorts all rows."""
    df = QUERIES["prices_dedupe_first"](spark, SF001)
    text = plan_text(df)
    assert "SortAggregate" not in text and "SortMergeJoin" not in text
    alone = text[:text.index("Window")]
    assert "LeftAnti" in alone and "Exchange hashpartitioning" not in alone
    assert "WindowGroupLimit" in text       # a hot key leaves one row a task
    log = price_log_records(spark, SF001)
    keys = log.groupBy("product", "date").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    assert "HashAggregate" in plan_text(keys) and "SortAggregate" not in plan_text(keys)
    assert "l_extendedprice" not in plan_text(keys)


def test_observe_rows(spark):
    df, obs = observe_rows(spark.range(10), "rows_in")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 10


def test_pivot_single_and_report_selection(spark):
    long = spark.createDataFrame([("20181", "Own1", 80.0), ("20181", "North Region Average", 70.0)],
                                 "period string, metric string, value double")
    wide = pivot_single(long, ["period"], "metric", ["Own1", "North Region Average"])
    assert wide.columns == ["period", "Own1", "North Region Average"]
    assert tuple(wide.first()) == ("20181", 80.0, 70.0)
    rows = spark.createDataFrame([(" NORTH", "O'Neil"), ("South", "O'Neil")], "region string, owner_name string")
    assert report_for(rows, "north", "O'Neil").count() == 1


def test_snapshot_read_or_build(spark, scratch):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    day = dt.date(2018, 8, 28)
    a = read_or_build_snapshot(spark, scratch, "hier", day, build)
    b = read_or_build_snapshot(spark, scratch, "hier", day, build)
    assert a.count() == b.count() == 3 and len(calls) == 1
    read_or_build_snapshot(spark, scratch, "hier", day + dt.timedelta(days=1), build)
    assert len(calls) == 2


def test_score_joins_reuse_totals_partitioning(spark):
    """Static plan (no AQE, no broadcast): the KPI and score joins are keyed
    like the totals aggregate, so only the slot rows and the survey are
    shuffled for them; nothing is re-shuffled by wave."""
    from sitegauge.sources.standins import supplier_world
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        card = sc.build_scorecard(supplier_world(spark, SF001))
        text = re.sub(r"#\d+L?", "", plan_text(card.scored))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "hashpartitioning(site_id, wave_id" not in text
    assert text.count("Exchange hashpartitioning(site_id, year, trimester, is_ptd") == 2
    assert text.count("Exchange hashpartitioning(site_id, _groupingexpression") == 1
