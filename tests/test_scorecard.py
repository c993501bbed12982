"""A hand-made run: window 2018-07 (open period 2, months 5-7)."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from sitegauge.plans import scorecard as sc
from sitegauge.plans.reports import UNASSIGNED, wide_scored, write_reports, write_scored
from sitegauge.sources.standins import World

D = dt.datetime


@pytest.fixture(scope="module")
def world(spark):
    roster = spark.createDataFrame([("A", "NORTH ", "d1"), ("B", "north", "d1"), ("C", "North", "d2")],
                                   "site_id string, region string, district string")
    hierarchy = spark.createDataFrame([("A", "Own1", "1", "a st", "x"), ("B", "Own1", "1", "b st", "y"),
                                       ("C", "", "2", "c st", "z")],
                                      "site_id string, owner_name string, owner_number string, "
                                      "address string, city string")
    vol = spark.createDataFrame([
        ("A", D(2017, 6, 15), 100, 200), ("A", D(2018, 6, 15), 102, 207), ("A", D(2018, 2, 1), 50, 0),
        ("A", D(2017, 2, 1), 40, 0), ("B", D(2017, 5, 20), 0, 0), ("B", D(2018, 5, 20), 5, 5),
        ("C", D(2018, 7, 1), 10, 10), ("Z", D(2018, 7, 1), 999, 999)],
        "site_id string, ts timestamp, volume int, premium_volume int").select(
        "site_id", "ts", F.col("volume").cast("decimal(18,2)").alias("volume"),
        F.col("premium_volume").cast("decimal(18,2)").alias("premium_volume"))
    loy = spark.createDataFrame([
        ("A", D(2018, 6, 20), 10.0), ("B", D(2018, 5, 21), 0.5), ("C", D(2018, 7, 2), 1.0),
        ("A", D(2018, 2, 20), 5.0), ("Z", D(2018, 3, 1), 7.0)],
        "site string, ts timestamp, v double").select(
        F.struct(F.col("site").alias("location_number")).alias("location_master"), "ts",
        F.col("v").cast("decimal(21,4)").alias("loyalty_volume"))
    yes = ("Yes",) * 8
    survey = spark.createDataFrame([
        ("A", "20182", "TM1", "S") + yes + (80.0,), ("B", "20182", "TM1", "S") + yes + (60.0,),
        ("C", "20182", "TM2", "S", None, None, None, "Yes", "Yes", "Yes", None, "Yes", 70.0),
        ("Q", "20182", "TM3", "S") + yes + (10.0,), ("R", "20182", None, "S") + yes + (20.0,)],
        "`LOCATION#` string, WAVID string, `TERRITORY MANAGER` string, `SALES MANAGER` string, "
        "Q7 string, Q8 string, Q9 string, Q10 string, Q11 string, Q12 string, Q14 string, Q18 string, "
        "SESCORE double")
    assign = spark.createDataFrame([("TM1", "NORTH"), ("TM2", "SKIP FOR NOW"), ("TM3", "north")],
                                   "territory_manager string, region string")
    return World("hand", dt.date(2018, 8, 10), roster, hierarchy, vol, loy, [survey], assign)


@pytest.fixture(scope="module")
def card(world):
    return sc.build_scorecard(world)


def test_window_and_slots(card):
    w = card.plan.window
    assert (w.max_year, w.max_month, w.is_open, w.prev_period_end, w.label) == (2018, 7, True, 4, 2)
    slots = {(p.year, p.trimester, p.is_ptd): (p.growth_ok, p.pen_ok, p.score_ok) for p in card.plan.pairs}
    assert slots == {(2018, 2, True): (True, True, True), (2018, 1, False): (True, True, False)}


def test_prior_year_open_months_feed_both(card):
    t = {(r["site_id"], r["year"], r["trimester"], r["is_ptd"]): r for r in card.totals.collect()}
    assert t[("A", 2017, 2, False)]["volume"] == 100.0
    assert t[("A", 2017, 2, True)]["volume"] == 100.0
    assert t[("A", 2018, 2, True)]["prev_volume"] == 100.0
    # open months of the latest year are PTD only; the closed slot carries the prior year alone
    assert t[("A", 2018, 2, False)]["volume"] is None
    assert t[("A", 2018, 2, False)]["prev_volume"] == 100.0
    assert ("Z", 2018, 3, False) not in t          # volume of non-roster sites is not pulled
    assert t[("Z", 2018, 1, False)]["loyalty_volume"] == 7.0   # loyalty is pulled for every site


def test_points_and_totals(card):
    s = {(r["site_id"], r["is_ptd"]): r for r in card.scored.collect()}
    a, b, c = s[("A", True)], s[("B", True)], s[("C", True)]
    assert a["volume_growth"] == 102 / 100 - 1 and a["volume_points"] == 10
    assert a["premium_points"] == 0                                   # 207/200-1 < 0.035 in double
    assert a["penetration_points"] == 25 and a["total"] == 75.0
    assert b["volume_growth"] == math.inf and b["premium_growth"] == math.inf
    assert (b["volume_points"], b["premium_points"], b["penetration_points"]) == (10, 20, 30)
    assert c["volume_growth"] is None and c["volume_points"] == 0     # missing base earns nothing
    assert c["facility_points"] is None and c["total"] is None        # missing ratio -> missing total
    assert ("A", False) not in s                                      # wave 20181 never surveyed
    k = {r["site_id"]: r for r in card.kpis.where("NOT is_ptd").collect()}
    assert k["A"]["volume_growth"] == 50 / 40 - 1 and k["A"]["penetration"] == 0.1


def test_only_survey_rows_of_scored_slots_are_joined(card, spark):
    """Other slots' survey rows are left before the join, and the scores are the same;
    a stand-in's survey is written once, as the scorecard's own table."""
    every, own = sc.score_table(card.kpis, card.survey), sc.score_table(card.kpis, card.survey, card.plan.pairs)
    assert own.count() > 0 and sorted(map(str, every.collect())) == sorted(map(str, own.collect()))
    none = sc.score_table(card.kpis, card.survey, [])
    assert none.where("service_ratio is not null").count() == 0 < own.where("service_ratio is not null").count()
    from sitegauge.sources.standins import customer_world
    stand_in = customer_world(spark, "/root/testdata/sf0.001")
    built = sc.build_scorecard(stand_in)
    assert stand_in.survey_files._files is None
    assert sorted(map(str, built.survey.collect())) == sorted(map(str, sc.survey_table(stand_in).collect()))


def test_rank_and_averages(card, world):
    ranks = {r["site_id"]: (r["region"], r["rank"]) for r in sc.region_rank(card).collect()}
    assert ranks == {"B": ("North", 1), "A": ("North", 2), "C": ("North", 3)}
    avg = {(r["owner_name"], r["wave_id"]): r for r in sc.owner_region_averages(card).collect()}
    assert avg[("Own1", "20182")]["owner_avg"] == 87.5
    assert avg[("Own1", "20182")]["region_avg"] == 87.5   # C's total is missing, skipped by the mean
    mvo = {r["wave_id"]: r for r in sc.member_vs_other(card, world.assignment).collect()}
    row = mvo["20182"]
    # members A, B (C is skipped), non-member Q; R has no manager -> no region -> dropped
    assert row["region"] == "North" and row["experience_member"] == 70.0
    assert row["experience_non_member"] == 10.0


def test_reports_partitioned(card, world, spark, scratch):
    paths = write_reports(card, world.assignment, scratch)
    raw = spark.read.parquet(paths["raw"])
    assert raw.count() == 3
    owners = {r[0] for r in raw.select("owner_name").distinct().collect()}
    assert owners == {"Own1", UNASSIGNED}                 # C has an empty owner name
    assert os.path.isdir(os.path.join(paths["raw"], "region=North", "owner_name=Own1"))
    p = write_scored(card, scratch, dt.date(2018, 8, 10))
    assert spark.read.parquet(p).count() == card.scored.count()


def test_wide_names(card):
    wide = wide_scored(card)
    for c in ("Total_Score_2018PTD2", "Volume_Growth_2018PTD2", "Loyalty_Pen_Score_2018PTD2", "Rank_20182"):
        assert c in wide.columns
    assert wide.count() == 3


def test_latest_months_reported(card):
    assert card.plan.latest == {"volume": (2018, 7), "loyalty": (2018, 7)}
    assert not card.plan.facts_disagree


def test_no_facts_gives_empty_outputs(world):
    import dataclasses
    empty = dataclasses.replace(world, volume_records=world.volume_records.limit(0),
                                loyalty_records=world.loyalty_records.limit(0))
    card = sc.build_scorecard(empty)
    assert card.plan.window is None and card.plan.pairs == []
    assert card.scored.count() == 0
    assert sc.region_rank(card).count() == 0
    assert sc.owner_region_averages(card).count() == 0


def test_same_day_rerun_reads_snapshots(world, spark, scratch):
    import dataclasses
    first = sc.build_scorecard(world, snapshot_root=scratch)
    assert os.path.isdir(os.path.join(scratch, "hand_monthly", "run_date=2018-08-10"))
    # A re-run whose sources are gone still scores from the day's snapshots.
    gone = dataclasses.replace(world, volume_records=world.volume_records.limit(0),
                               loyalty_records=world.loyalty_records.limit(0), survey_files=[])
    again = sc.build_scorecard(gone, snapshot_root=scratch)
    key = ["site_id", "year", "trimester", "is_ptd", "total"]
    assert sorted(map(tuple, first.scored.select(key).collect())) == \
        sorted(map(tuple, again.scored.select(key).collect()))
