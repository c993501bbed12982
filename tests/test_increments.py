"""Fact store and part-by-part period totals."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF001
from sitegauge.functions.calendar import reporting_calendar
from sitegauge.plans import increments
from sitegauge.plans.periods import LOYALTY, VOLUME, flatten_loyalty, period_facts, period_totals
from sitegauge.registry import QUERIES
from sitegauge.sources import fact_store
from sitegauge.sources.standins import supplier_world

VOLUME_TYPE = "site_id string, ts timestamp_ntz, volume decimal(18,2), premium_volume decimal(18,2)"
LOYALTY_TYPE = "site_id string, ts timestamp_ntz, loyalty_volume decimal(22,4)"


def at(text):
    return dt.datetime.fromisoformat(text)


def volume(spark, rows):
    return spark.createDataFrame([(s, at(t), v, p) for s, t, v, p in rows], VOLUME_TYPE)


def dec(x):
    import decimal
    return None if x is None else decimal.Decimal(x)


def test_only_touched_parts_are_read_and_corrections_replace(spark, scratch):
    store, state = os.path.join(scratch, "volume"), os.path.join(scratch, "state")
    cal = reporting_calendar(dt.date(2001, 9, 10))
    roster = spark.createDataFrame([("a",), ("b",)], "site_id string")
    first = volume(spark, [("a", "2000-01-05", dec("1.10"), dec("0")), ("a", "2000-01-06", dec("2.20"), None),
                           ("b", "2000-02-01", None, None), ("c", "2000-02-01", dec("9"), dec("9")), ("a", "1990-01-01", dec("5"), dec("5"))])
    fact_store.write_facts(first, store)
    assert increments.refresh(spark, store, state, VOLUME) == ["1990-01", "2000-01", "2000-02"]
    assert increments.refresh(spark, store, state, VOLUME) == []
    got = {(r.site_id, r.year, r.month): (r.volume, r.n_rows) for r in increments.monthly_sums(spark, state, roster, cal).collect()}
    assert got == {("a", 2000, 1): (dec("3.30"), 2), ("b", 2000, 2): (None, 1)}     # roster sites, since the scan bound
    # a correction of one part and a new one; the others keep the run that made them
    fact_store.write_facts(volume(spark, [("a", "2000-01-07", dec("7.00"), dec("1")), ("b", "2001-03-01", dec("4"), dec("0"))]), store)
    assert increments.refresh(spark, store, state, VOLUME) == ["2000-01", "2001-03"]
    runs = {r.part: r.run for r in increments.ledger(spark, state).collect()}
    assert runs == {"1990-01": 1, "2000-02": 1, "2000-01": 2, "2001-03": 2}
    got = {(r.site_id, r.year, r.month): r.volume for r in increments.monthly_sums(spark, state, roster, cal).collect()}
    assert got == {("a", 2000, 1): dec("7.00"), ("b", 2000, 2): None, ("b", 2001, 3): dec("4.00")}


def test_failed_runs_are_repeated_and_gone_parts_leave(spark, scratch, monkeypatch):
    store, state = os.path.join(scratch, "volume"), os.path.join(scratch, "state")
    cal, roster = reporting_calendar(dt.date(2001, 9, 10)), spark.createDataFrame([("a",)], "site_id string")
    fact_store.write_facts(volume(spark, [("a", "2000-01-05", dec("1"), None), ("a", "2000-03-05", dec("2"), None)]), store)
    with monkeypatch.context() as m:
        m.setattr(increments, "LEDGER", "no schema")    # the run dies between the sums and the ledger
        try:
            increments.refresh(spark, store, state, VOLUME)
            raise AssertionError("the run should have failed")
        except Exception as e:
            assert "should have failed" not in str(e)
    assert increments.refresh(spark, store, state, VOLUME) == ["2000-01", "2000-03"]
    assert increments.monthly_sums(spark, state, roster, cal).count() == 2
    gone = os.path.join(store, "part=2000-03")
    for name in os.listdir(gone):
        os.remove(os.path.join(gone, name))
    assert increments.refresh(spark, store, state, VOLUME) == ["2000-03"]
    assert [r.month for r in increments.monthly_sums(spark, state, roster, cal).collect()] == [1]
    assert increments.refresh(spark, store, state, VOLUME) == []


def test_increments_equal_one_pass(spark, scratch):
    world = supplier_world(spark, SF001)
    cal = reporting_calendar(world.run_date)
    facts = {VOLUME: world.volume_records.select("site_id", "ts", "volume", "premium_volume"),
             LOYALTY: flatten_loyalty(world.loyalty_records).withColumn("loyalty_volume", F.col("loyalty_volume").cast("decimal(22,4)"))}
    for source, rows in facts.items():
        store = os.path.join(scratch, source)
        for cut in ("1996-01-01", "2000-06-01", "2100-01-01"):
            fact_store.write_facts(rows.where(F.col("ts") < F.lit(cut).cast("timestamp_ntz")), store)
            increments.refresh(spark, store, f"{scratch}/state", source)
    got = increments.incremental_totals(spark, f"{scratch}/state", world.roster, cal)
    monthly, _, window = period_facts(world, cal)
    want = period_totals(monthly, window)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_last_day_reads_no_rows(spark, scratch):
    rows = volume(spark, [("a", "2000-01-05", dec("1"), None), ("b", "2000-04-30", None, None), ("b", "1999-12-31", None, None)])
    for unit, parts in (("month", ["1999-12", "2000-01", "2000-04"]), ("day", ["1999-12-31", "2000-01-05", "2000-04-30"])):
        store = os.path.join(scratch, unit)
        fact_store.write_facts(rows, store, unit)
        states = fact_store.part_states(spark, store).collect()
        assert sorted(r.part for r in states) == parts and len({r.fingerprint for r in states}) == 3
        assert fact_store.latest_month(spark, store) == (2000, 4)
        with fact_store.footer_aggregates(spark):
            plan = fact_store.last_day(spark, store)._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [MAX(day)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_bounds_prune_parts(spark, scratch):
    store = os.path.join(scratch, "v")
    fact_store.write_facts(volume(spark, [("a", f"{y}-0{m}-05", dec("1"), None) for y in range(1995, 2002) for m in (1, 5)]), store)
    recent = fact_store.read_facts(spark, store, increments.FACTS[VOLUME]).where(F.col("part") >= "2001")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "2001" in plan
    assert recent.count() == 2 and len(recent.inputFiles()) == 14    # pruning is of the scan, not of the listing


def test_laid_out_facts_meet_and_sum_without_a_shuffle(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold",)
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")          # no table is small at scale
    try:
        df = QUERIES["volume_by_layout"](spark, SF001)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "LeftSemi" in plan and "Exchange" not in plan
    assert plan.count("Bucketed: true") == 2 and "PartitionFilters: [isnotnull(part" in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert df.count() == QUERIES["volume_semi_sum"](spark, SF001).count()
