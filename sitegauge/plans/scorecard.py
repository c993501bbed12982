"""Site scorecard in long form.

Every fact stays one row per ``(site_id, year, trimester, is_ptd)``; the
run-time column names of the wide report (``Volume_20012``, ``Total_Score_20013``)
exist only in :mod:`sitegauge.plans.reports`.

Scale notes:

* the only driver-side reads are the (source, year, month) triples present
  and the survey wave list: both are bounded by the calendar, not by the
  data, and they run side by side;
* the roster x scored-period product is an ``explode`` of a literal array of
  at most seven period slots per site, not a join; region and owner ride on
  those rows, so ranking and averages never join back to the sites;
* the KPI and score joins are keyed exactly like the totals aggregate
  (site, year, trimester, is_ptd), so its exchange serves both; the other
  joins are on ``site_id`` or against a table bounded by construction
  (region assignment, broadcast after a row-count check);
* the rank is computed with :func:`rank_within`, which splits a region that
  holds a large share of all sites over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.functions.calendar import ReportingCalendar, reporting_calendar
from sitegauge.functions.columns import flag_label, growth, ieee_ratio, key_text, normalise_label
from sitegauge.operators.aggregates import mean_by
from sitegauge.operators.dedupe import latest_per_key
from sitegauge.operators.joins import existence_flag, not_equal_keep_null, null_safe_left_join
from sitegauge.operators.ranking import rank_within
from sitegauge.plans.periods import (Pair, PeriodPlan, monthly_facts, period_totals, plan_pairs,
                                     present_months, window_of)
from sitegauge.plans.survey_scores import survey_ratios
from sitegauge.session import concurrently, freeze_many
from sitegauge.sources.snapshot import read_or_build_snapshot
from sitegauge.sources.survey import normalise_files

# Fixed values of the scoring rule (points per KPI band).
PENETRATION_BANDS = ((0.1, 30), (0.05, 25))   # checked in this order
VOLUME_GROWTH_CUT, VOLUME_GROWTH_POINTS = 0.02, 10
PREMIUM_GROWTH_CUT, PREMIUM_GROWTH_POINTS = 0.035, 20
RATIO_POINTS = 20
# Region value that removes a site from the members-vs-others comparison.
SKIP_REGION = "SKIP FOR NOW"

PAIR_COLS = ("year", "trimester", "is_ptd")


@dataclass
class Scorecard:
    """Everything one run derives, as lazily evaluated DataFrames."""

    world: str
    calendar: ReportingCalendar
    plan: PeriodPlan
    roster: DataFrame        # site_id, region (normalised), district
    sites: DataFrame         # roster + hierarchy (owner_name, ...)
    survey: DataFrame        # canonical survey rows with ratios
    totals: DataFrame        # period totals per site
    kpis: DataFrame          # roster sites x KPI slots (with region, owner)
    scored: DataFrame        # roster sites x scored slots, with points


def prepare_roster(roster: DataFrame) -> DataFrame:
    """Site key as text (a numeric key goes through bigint, so ``101.0``
    never appears, D18), region title-cased and trimmed once, here (D10)."""
    return roster.select(
        key_text(roster, "site_id").alias("site_id"),
        normalise_label("region").alias("region"), "district")


def enrich_sites(roster: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Roster left-joined with the owner hierarchy (S8, J1); owners with an
    empty name are not part of the hierarchy source."""
    owners = hierarchy.where(F.col("owner_name").isNotNull() & (F.col("owner_name") != ""))
    return roster.join(owners, "site_id", "left")


def survey_table(world, once: bool = False) -> DataFrame:
    """Survey files of both layouts, unioned and scored (V1, U1, C1, C2). With
    ``once`` the caller reads the table a single time, so files that are rendered
    from a table need no copy of their own."""
    files = world.survey_files
    return survey_ratios(normalise_files(files.once() if once and hasattr(files, "once") else files))


def _slot_array(pairs: list[Pair]) -> Column:
    return F.array(*[
        F.struct(F.lit(p.year).cast("long").alias("year"),
                 F.lit(p.trimester).cast("long").alias("trimester"),
                 F.lit(p.is_ptd).alias("is_ptd"),
                 F.lit(p.pen_ok).alias("pen_ok"),
                 F.lit(p.score_ok).alias("score_ok"))
        for p in pairs])


# Site attributes carried along every slot row, so that ranking and averages
# need no join back to the sites (the slot rows keep the totals' partitioning).
CARRIED = ("region", "owner_name")


def kpi_table(roster: DataFrame, totals: DataFrame, plan: PeriodPlan) -> DataFrame:
    """Growth and penetration per roster site and KPI slot (K1-K4).

    A slot is present for every roster site once its inputs exist for any
    site; a site without rows gets NULL KPIs, which later earn 0 points.
    """
    carry = [c for c in CARRIED if c in roster.columns]
    if not plan.pairs:
        return (roster.select("site_id", *carry).limit(0)
                .select("site_id", *carry,
                        *[F.lit(None).cast(t).alias(c) for c, t in _KPI_TYPES]))
    slots = roster.select("site_id", *carry, F.explode(_slot_array(plan.pairs)).alias("s")).select(
        "site_id", *carry,
        *[F.col(f"s.{c}").alias(c) for c in (*PAIR_COLS, "pen_ok", "score_ok")])
    joined = slots.join(totals, ["site_id", *PAIR_COLS], "left")
    return joined.select(
        "site_id", *carry, *PAIR_COLS, "score_ok",
        "volume", "prev_volume", "premium_volume", "prev_premium_volume", "loyalty_volume",
        growth("volume", "prev_volume").alias("volume_growth"),
        growth("premium_volume", "prev_premium_volume").alias("premium_growth"),
        F.when(F.col("pen_ok"), ieee_ratio("loyalty_volume", "volume")).alias("penetration"))


_KPI_TYPES = (("year", "long"), ("trimester", "long"), ("is_ptd", "boolean"),
              ("score_ok", "boolean"), ("volume", "double"), ("prev_volume", "double"),
              ("premium_volume", "double"), ("prev_premium_volume", "double"),
              ("loyalty_volume", "double"), ("volume_growth", "double"),
              ("premium_growth", "double"), ("penetration", "double"))


def penetration_points(c: Column) -> Column:
    out = None
    for cut, pts in PENETRATION_BANDS:
        out = F.when(c >= cut, F.lit(pts)) if out is None else out.when(c >= cut, F.lit(pts))
    return out.otherwise(F.lit(0)).cast("long")


def score_table(kpis: DataFrame, survey: DataFrame, pairs: list[Pair] | None = None) -> DataFrame:
    """Points and total per roster site and scored slot (K5-K7).

    A missing KPI earns 0 points (a NULL comparison is false, as a NaN one
    is in pandas); a missing survey ratio makes its points and the total
    NULL. Thresholds are compared on the unrounded double KPIs (T15). With the
    plan's ``pairs``, survey rows of other slots, which no scored row meets,
    are left before the join.
    """
    # The survey row of wave yyyy+t serves the closed slot (yyyy, t) and the
    # period-to-date slot of the same label. Keying the join exactly like the
    # KPI rows (site, year, trimester, is_ptd) means only the survey side is
    # shuffled; the KPI rows keep the partitioning of the totals join.
    ratios = survey.select(
        "site_id",
        F.substring("wave_id", 1, 4).try_cast("long").alias("year"),
        F.expr("substring(wave_id, 5)").try_cast("long").alias("trimester"),
        F.explode(F.array(F.lit(False), F.lit(True))).alias("is_ptd"),
        "service_ratio", "facility_ratio", "experience_score")
    if pairs is not None:
        scored_slots = [_slot_filter(p) for p in pairs if p.score_ok]
        ratios = ratios.where(reduce(or_, scored_slots, F.lit(False)))
    wave = F.concat(F.col("year").cast("string"), F.col("trimester").cast("string"))
    scored = (kpis.where(F.col("score_ok")).drop("score_ok")
              .join(ratios, ["site_id", "year", "trimester", "is_ptd"], "left")
              .withColumn("wave_id", wave))
    pts = scored.select(
        "*",
        penetration_points(F.col("penetration")).alias("penetration_points"),
        F.when(F.col("volume_growth") >= VOLUME_GROWTH_CUT, F.lit(VOLUME_GROWTH_POINTS))
        .otherwise(F.lit(0)).cast("long").alias("volume_points"),
        F.when(F.col("premium_growth") >= PREMIUM_GROWTH_CUT, F.lit(PREMIUM_GROWTH_POINTS))
        .otherwise(F.lit(0)).cast("long").alias("premium_points"),
        (F.col("service_ratio") * RATIO_POINTS).alias("service_points"),
        (F.col("facility_ratio") * RATIO_POINTS).alias("facility_points"))
    return pts.withColumn(
        "total",
        F.col("penetration_points") + F.col("volume_points") + F.col("premium_points")
        + F.col("service_points") + F.col("facility_points"))


def present_waves(survey: DataFrame) -> set[str]:
    """Well-formed wave ids (``yyyyt``) of the survey: the calendar bounds what
    is collected, whatever free text the export holds."""
    found = survey.where(F.col("wave_id").rlike("^[0-9]{4}[1-3]$")).select("wave_id").distinct()
    return {r[0] for r in found.collect()}


def build_scorecard(world, period_label: int | None = None,
                    snapshot_root: str | None = None) -> Scorecard:
    """Everything a run derives. ``period_label`` overrides the period
    number taken from the data (D2); by default it is the trimester of the
    latest data month. With ``snapshot_root`` the two pulls (monthly facts,
    survey) are dated snapshots: a second run on the same run date reads
    them instead of pulling again (S12)."""
    calendar = reporting_calendar(world.run_date)
    roster = prepare_roster(world.roster)
    # Monthly facts feed the window, the slot plan and the totals; the survey
    # feeds the wave list, the score join and both sides of the
    # members-vs-others comparison. Both are materialised once, side by side
    # (independent inputs), then the two small driver reads run side by side.
    pulls = {
        "monthly": lambda: monthly_facts(world.volume_records, world.loyalty_records,
                                         world.roster, calendar),
        "survey": lambda: survey_table(world, once=True)}
    if snapshot_root is None:
        frozen = freeze_many({name: pull() for name, pull in pulls.items()})
        monthly, survey = frozen["monthly"], frozen["survey"]
    else:
        spark = world.roster.sparkSession
        monthly, survey = concurrently(*[
            (lambda n=name, p=pull: read_or_build_snapshot(
                spark, snapshot_root, f"{world.name}_{n}", world.run_date, p))
            for name, pull in pulls.items()])
    months, waves = concurrently(
        lambda: present_months(monthly),
        lambda: present_waves(survey))
    window = window_of(months, period_label)
    totals = period_totals(monthly, window) if window is not None else None
    plan = plan_pairs(months, window, waves)
    if totals is None:
        totals = monthly.limit(0)
    sites = enrich_sites(roster, world.hierarchy)
    kpis = kpi_table(sites, totals, plan)
    scored = score_table(kpis, survey, plan.pairs)
    return Scorecard(world.name, calendar, plan, roster, sites, survey, totals, kpis, scored)


def current_slot(sc: Scorecard) -> Pair | None:
    return sc.plan.current


def _slot_filter(p: Pair) -> Column:
    return ((F.col("year") == p.year) & (F.col("trimester") == p.trimester)
            & (F.col("is_ptd") == F.lit(p.is_ptd)))


def region_rank(sc: Scorecard) -> DataFrame:
    """Rank of each roster site within its region on the current total (W1):
    total descending, NULL totals last, ties by site id; NULL region ->
    NULL rank. No current slot (its inputs are missing) -> empty (D19)."""
    cur = current_slot(sc)
    base = sc.scored
    if cur is None:
        base = base.limit(0)
    else:
        base = base.where(_slot_filter(cur))
    picked = base.select("site_id", "region", "owner_name", "year", "trimester", "is_ptd",
                         "total")
    return rank_within(picked, ["region"],
                       [F.col("total").desc_nulls_last(), F.col("site_id").asc()], out="rank")


def owner_region_averages(sc: Scorecard) -> DataFrame:
    """Mean total per (owner, region) beside the region mean, per scored
    slot of the report years (K8, A4, J6). NULL owners or regions form no
    group; the region mean covers every site of the region."""
    years = sc.calendar.report_years()
    # One pass over the scored rows: sum and non-NULL count per (region,
    # wave, owner), NULL owners included; both means derive from that small
    # table (a mean of means would weight owners, not sites).
    parts = (sc.scored.where(F.col("year").isin(*years) & F.col("region").isNotNull())
             .groupBy("region", "wave_id", "owner_name")
             .agg(F.sum("total").alias("_s"), F.count("total").alias("_n")))
    owner_avg = parts.where(F.col("owner_name").isNotNull()).select(
        "region", "wave_id", "owner_name", F.try_divide("_s", "_n").alias("owner_avg"))
    region_avg = parts.groupBy("region", "wave_id").agg(
        F.try_divide(F.sum("_s"), F.sum("_n")).alias("region_avg"))
    return owner_avg.join(region_avg, ["region", "wave_id"], "left")


# Fixed value: label suffix of the region row in the owner's score sheet.
REGION_AVERAGE_SUFFIX = " Region Average"


def score_average_sheet(sc: Scorecard) -> DataFrame:
    """The owner's score-average sheet in long form (K8 presentation, R4,
    X9): per (region, owner, period) one row labelled with the owner name
    (owner mean) and one labelled ``<region> Region Average`` (region mean).
    Pivoting the label into columns is left to the reader of one report:
    owner names are unbounded, so they never become columns here."""
    avg = owner_region_averages(sc)
    long = avg.unpivot(["region", "owner_name", "wave_id"], ["owner_avg", "region_avg"],
                       "variable", "value")
    label = F.when(F.col("variable") == "region_avg",
                   F.concat(F.col("region"), F.lit(REGION_AVERAGE_SUFFIX))).otherwise(F.col("owner_name"))
    return long.select("region", "owner_name", F.col("wave_id").alias("period"),
                       label.alias("label"), "value")


def site_regions(survey: DataFrame, assignment: DataFrame) -> DataFrame:
    """Region of every surveyed site from the territory manager of its latest
    wave (A10, J7); NULL managers match NULL assignment keys like pandas.

    One manager may cover a large share of all sites. AQE broadcasts the
    assignment where its measured size allows; beyond that its skew join
    splits such a manager's sites."""
    latest = latest_per_key(survey, "site_id", "wave_id", ["territory_manager"])
    return null_safe_left_join(latest.select("site_id", "territory_manager"), assignment,
                               ["territory_manager"]).select("site_id", "region")


def member_vs_other(sc: Scorecard, assignment: DataFrame) -> DataFrame:
    """Survey means of roster members vs other surveyed sites, per region and
    wave (K9, J8, F9, J9, A4, R3).

    Sites whose region is the skip marker are dropped, sites without a
    region are kept by that filter and fall out at the grouping (D13).
    """
    regions = site_regions(sc.survey, assignment)
    rows = (sc.survey.select("site_id", "wave_id", "service_ratio", "facility_ratio",
                             "experience_score")
            .join(regions, "site_id", "left")
            .where(not_equal_keep_null("region", SKIP_REGION))
            .withColumn("region", normalise_label("region")))
    flagged = existence_flag(rows, sc.roster, "site_id", "member")
    labels = ("member", "non_member")
    means = (flagged.where(F.col("region").isNotNull())
             .withColumn("group", flag_label("member", *labels))
             .groupBy("region", "wave_id")
             .pivot("group", list(labels))
             .agg(F.avg("service_ratio").alias("service"),
                  F.avg("facility_ratio").alias("facility"),
                  F.avg("experience_score").alias("experience")))
    out = ["region", "wave_id"]
    for metric in ("service", "facility", "experience"):
        out += [F.col(f"{g}_{metric}").alias(f"{metric}_{g}") for g in labels]
    # rows whose cells are all missing drop out, as in an aggregating pivot
    return means.select(*out).where(F.coalesce(*[
        F.col(f"{m}_{g}") for m in ("service", "facility", "experience") for g in labels]).isNotNull())


def owner_survey_averages(sc: Scorecard) -> DataFrame:
    """Per-owner survey means of the report years."""
    years = [str(y) for y in sc.calendar.report_years()]
    rows = (sc.sites.select("site_id", "region", "owner_name")
            .join(sc.survey.where(F.substring("wave_id", 1, 4).isin(*years)), "site_id"))
    return mean_by(rows, ["owner_name", "region", "wave_id"],
                   ["service_ratio", "facility_ratio", "experience_score"]).select(
        "owner_name", "region", "wave_id",
        F.col("service_ratio").alias("service"), F.col("facility_ratio").alias("facility"),
        F.col("experience_score").alias("experience")).where("coalesce(service, facility, experience) is not null")


def owner_vs_region_survey(sc: Scorecard, assignment: DataFrame) -> DataFrame:
    """Per-owner survey means next to the region's member/non-member means
    (K10, J10: composite key)."""
    return owner_survey_averages(sc).join(member_vs_other(sc, assignment),
                                          ["region", "wave_id"], "left")
