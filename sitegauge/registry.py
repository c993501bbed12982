"""Named queries over the driver's tables, one per operator group of the
inventory. Each takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names equal those of the matching SQL in :mod:`sitegauge.oracle_sql`.

Results carry no dates or decimals (dates as ISO text, money as double) so
that the two engines produce identical values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.functions.calendar import reporting_calendar
from sitegauge.functions.columns import normalise_label, split_part, title_case
from sitegauge.operators.aggregates import (contingency, latest_month, non_null_counts,
                                            open_contingency)
from sitegauge.operators.dedupe import keep_first_late, latest_per_key
from sitegauge.operators.quality import observe_rows, zero_rows
from sitegauge.operators.ranking import running_sum
from sitegauge.operators.reshape import mean_pivot, melt, strict_pivot
from sitegauge.plans import scorecard as sc_mod
from sitegauge.plans.increments import incremental_totals, refresh
from sitegauge.plans.periods import (LOYALTY, VOLUME, at_or_after, daily_volume, flatten_loyalty,
                                     period_facts, period_totals)
from sitegauge.plans.prices import (PAGE_BODY, PAGE_CONTAINS, cleaned_log, dedupe_first,
                                    nav_link_pairs, page_texts, sort_final)
from sitegauge.plans.reports import INDEX, REPORT_KEYS, wide_scored, write_report_stores, write_scored
from sitegauge.plans.survey_scores import WIDE_LABELS
from sitegauge.session import ensure_checkpoint_dir
from sitegauge.sources.fact_store import latest_month as latest_stored_month
from sitegauge.sources.fact_store import write_bucketed, write_facts
from sitegauge.sources.price_log import append_log, clean_prices, parse_prices, read_price_log_text, write_final_csv
from sitegauge.sources.quarantine import read_log_lines, split, tagged
from sitegauge.sources.schemas import PRICE_LOG, VENDORS
from sitegauge.sources.standins import (PRICE_INGEST_ORDER, customer_world, price_log_records, price_log_source,
                                        price_log_text, supplier_world, table)

Query = Callable[[SparkSession, str], DataFrame]

WORLDS = (("customer", customer_world), ("supplier", supplier_world))
AVG_DIGITS = 9   # means are rounded here and in the SQL: summation order differs
SERVICE_NUMERATORS = tuple(range(0, 22, 3))


def _r(c) -> F.Column:
    return F.round(c, AVG_DIGITS)


def _ymd(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def _scorecards(spark: SparkSession, sf_dir: str):
    for name, build in WORLDS:
        world = build(spark, sf_dir)
        yield name, world, sc_mod.build_scorecard(world)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _per_world(fn: Callable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _union([fn(world, card).select(F.lit(name).alias("world"), "*")
                       for name, world, card in _scorecards(spark, sf_dir)])
    return run


# --- price history --------------------------------------------------------

def q_prices_clean(spark, sf_dir):
    """Every price-log row with money text parsed."""
    return cleaned_log(spark, sf_dir).drop("ingest_order", "ingest_line", "ingest_supplier",
                                           "ingest_amount")


def q_prices_dedupe_first(spark, sf_dir):
    """First row per (product, day) in ingest order (A9); prices are parsed in the
    rows that stay."""
    return clean_prices(dedupe_first(price_log_records(spark, sf_dir)))


def q_pages_class_text(spark, sf_dir):
    """Selected texts of every page, one row per (page, kind, position)."""
    return page_texts(table(spark, sf_dir, "pages"))


def q_pages_contains(spark, sf_dir):
    """Texts and targets by what a class or link contains, over whole pages (S3)."""
    return page_texts(table(spark, sf_dir, "pages"), PAGE_CONTAINS)


def q_pages_body_text(spark, sf_dir):
    """Direct texts of paragraphs, bold runs, footers and articles; paragraphs and
    bold runs are partly unclosed (S2)."""
    return page_texts(table(spark, sf_dir, "pages"), PAGE_BODY)


def q_lists_zip(spark, sf_dir):
    """Navigation link texts and targets zipped by position."""
    return nav_link_pairs(table(spark, sf_dir, "pages"))


def _folder(spark, name: str) -> str:
    """A new folder on the shared storage."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _log_lines(spark, sf_dir, folder: str) -> str:
    """The stand-in log as CSV text in ingest order, as scrape runs append it. Rows are
    sorted as they stand in the table and made text where they are written."""
    path = f"{folder}/csv"
    raw = price_log_text(price_log_source(spark, sf_dir).orderBy(*PRICE_INGEST_ORDER))
    (raw.select("product", *VENDORS, "date")
     .write.option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return path


def q_prices_csv_job(spark, sf_dir):
    """The price job over files: the CSV log is read in file order, appended to the
    stored log by year (one year twice, as a re-run does), de-duplicated, written
    as the final CSV list and read back (S5, Z1, A9, O2, Z2)."""
    folder = _folder(spark, "prices")
    lines = read_price_log_text(spark, _log_lines(spark, sf_dir, folder)).withColumn(
        "snapshot_date", F.substring("date", 7, 4))
    log = parse_prices(lines)
    append_log(log, f"{folder}/log")
    first_year = F.col("snapshot_date") == F.lit("1995")
    append_log(parse_prices(lines.where(first_year)), f"{folder}/log")
    stored = spark.read.schema(log.schema).parquet(f"{folder}/log")
    final = keep_first_late(stored, ["product", "date"], ["ingest_file", "ingest_seq"], keep=["product", *VENDORS, "date"])
    write_final_csv(sort_final(final.select("product", *VENDORS, "date")), f"{folder}/final")
    return spark.read.schema(PRICE_LOG).option("header", True).option("quote", '"').option("escape", '"').csv(f"{folder}/final")


def q_rejected_rows(spark, sf_dir):
    """Faulty lines of a CSV log, by rule: some of the stand-in's rows are written with a
    field missing, without a product, with a day in another order, with words for a
    price or a negative one; each comes back with its reasons (S5, V4)."""
    folder = _folder(spark, "rejects")
    raw = price_log_records(spark, sf_dir)
    kind = (F.col("ingest_order") * 8 + F.col("ingest_line")) % 97
    price = F.format_string("%.2f", F.col("ingest_amount"))
    day = F.when(kind == 4, F.concat(F.substring("date", 7, 4), F.lit("-"), F.substring("date", 1, 2))).otherwise(F.col("date"))
    first = F.when(kind == 5, F.lit("sold out")).when(kind == 6, F.concat(F.lit("-"), price)).otherwise(price)
    product = F.when(kind == 3, F.lit("")).otherwise(F.col("product"))
    whole = F.concat_ws(",", product, first, *[F.lit("N/A")] * (len(VENDORS) - 1), day)
    lines = raw.select(F.when(kind == 2, F.concat_ws(",", product, first, day)).otherwise(whole).alias("value"))
    lines.write.text(f"{folder}/csv")
    _, rejected = split(tagged(read_log_lines(spark, f"{folder}/csv", header=False)))
    return rejected.select("product", F.col("apple").alias("price"), "date", "raw_line", F.array_join("reasons", "; ").alias("reasons"))


# --- survey -----------------------------------------------------------------

def _survey(spark, sf_dir):
    return sc_mod.survey_table(customer_world(spark, sf_dir))


def q_layout_union(spark, sf_dir):
    """Both survey layouts normalised and unioned."""
    from sitegauge.sources.survey import normalise_files
    return normalise_files(customer_world(spark, sf_dir).survey_files)


def q_survey_ratios(spark, sf_dir):
    """Service and facility ratios per survey row."""
    return _survey(spark, sf_dir).select(
        "site_id", "wave_id", "service_num", "service_den", "service_ratio",
        "facility_num", "facility_den", "facility_ratio")


def _survey_wide(spark, sf_dir):
    """The survey of every wave in it, wide. A wave id that is none fails the
    pivot, so the calendar bounds the columns."""
    survey = sc_mod.survey_table(customer_world(spark, sf_dir))
    renamed = survey.select("site_id", "wave_id", *[F.col(m).alias(lbl) for m, lbl in WIDE_LABELS.items()])
    return strict_pivot(renamed, ["site_id"], "wave_id", sorted(sc_mod.present_waves(survey)), list(WIDE_LABELS.values()))


def q_survey_pivot(spark, sf_dir):
    """Strict pivot of the survey over every wave present."""
    return _survey_wide(spark, sf_dir)


def q_latest_wave(spark, sf_dir):
    """Latest wave and territory manager per site (A10)."""
    return latest_per_key(_survey(spark, sf_dir), "site_id", "wave_id", ["territory_manager"])


def q_wave_counts(spark, sf_dir):
    """Non-NULL counts per wave."""
    s = _survey(spark, sf_dir).select("wave_id", "site_id", "q7", "q8", "q9", "q10", "q11",
                                      "q12", "q14", "q18", "experience_score")
    return non_null_counts(s, "wave_id")


def q_crosstab_counts(spark, sf_dir):
    """Service score by denominator counts."""
    return contingency(_survey(spark, sf_dir), "service_den", "service_num",
                       SERVICE_NUMERATORS, strict=True)


def q_crosstab_open(spark, sf_dir):
    """Answers to one survey question by territory manager, of whatever values there
    are, missing ones a category (A6 with missing values kept, V4)."""
    return open_contingency(_survey(spark, sf_dir), "territory_manager", "q7")


def q_log_sizes(spark, sf_dir):
    """Rows of the price log before and after keep-first, counted in passing by the
    job that writes the list (S13)."""
    folder = _folder(spark, "sizes")
    log, before = observe_rows(price_log_records(spark, sf_dir), "log")
    log.write.parquet(f"{folder}/log")
    final, after = observe_rows(dedupe_first(spark.read.schema(log.schema).parquet(f"{folder}/log")), "final")
    final.write.parquet(f"{folder}/final")
    return spark.createDataFrame([("log", before.get["rows"]), ("final", after.get["rows"])], "step string, row_count long")


def q_zero_scores(spark, sf_dir):
    """Survey rows with a zero service score."""
    return zero_rows(_survey(spark, sf_dir), "service_num").select(
        "site_id", "wave_id", "service_num", "service_den")


def q_unpivot_split(spark, sf_dir):
    """Wide survey melted back, metric and period split out."""
    wide = _survey_wide(spark, sf_dir)
    long = melt(wide, ["site_id"], [c for c in wide.columns if c != "site_id"])
    return long.select("site_id", "variable", "value",
                       split_part("variable", "_", 1).alias("metric"),
                       split_part("variable", "_", 2).alias("period"))


def q_pivot_mean(spark, sf_dir):
    """Mean of each survey metric per region and period."""
    long = q_unpivot_split(spark, sf_dir)
    roster = sc_mod.prepare_roster(customer_world(spark, sf_dir).roster)
    joined = long.join(roster.select("site_id", "region"), "site_id")
    metrics = list(WIDE_LABELS.values())
    wide = mean_pivot(joined, ["region", "period"], "metric", metrics)
    return wide.select("region", "period", *[_r(F.col(m)).alias(m) for m in metrics])


# --- facts and periods ------------------------------------------------------

def q_volume_semi_sum(spark, sf_dir):
    """Daily volume sums of roster sites from the scan bound on."""
    world = customer_world(spark, sf_dir)
    cal = reporting_calendar(world.run_date)
    return daily_volume(world.volume_records, world.roster, cal.volume_start).select(
        "site_id", _ymd("day").alias("day"), "volume", "premium_volume")


FACT_BUCKETS = 16


def q_volume_by_layout(spark, sf_dir):
    """The same daily sums from facts laid out by year and site: years before the bound
    are pruned, the roster is met and days are summed without a shuffle (S9, F11, J11)."""
    world = customer_world(spark, sf_dir)
    cal = reporting_calendar(world.run_date)
    folder, run = _folder(spark, "layout"), uuid.uuid4().hex
    facts = world.volume_records.withColumn("part", F.year("ts").cast("string"))
    facts = write_bucketed(facts, f"volume_{run}", f"{folder}/volume", FACT_BUCKETS, part="part")
    roster = write_bucketed(world.roster.select("site_id").distinct(), f"roster_{run}", f"{folder}/roster", FACT_BUCKETS)
    recent = facts.where(F.col("part") >= str(cal.volume_start.year))
    return daily_volume(recent, roster, cal.volume_start).select(
        "site_id", _ymd("day").alias("day"), "volume", "premium_volume")


def q_loyalty_by_parent(spark, sf_dir):
    """Loyalty records keyed through their parent site."""
    world = customer_world(spark, sf_dir)
    cal = reporting_calendar(world.run_date)
    flat = flatten_loyalty(world.loyalty_records)
    return flat.where(at_or_after(flat, "ts", cal.loyalty_start)).select(
        "site_id", _ymd("ts").alias("day"),
        F.col("loyalty_volume").cast("double").alias("loyalty_volume"))


def q_latest_month(spark, sf_dir):
    """Latest data month of each fact, both worlds (A5)."""
    frames = []
    for name, build in WORLDS:
        world = build(spark, sf_dir)
        cal = reporting_calendar(world.run_date)
        vol = world.volume_records.join(
            world.roster.select("site_id").distinct(), "site_id", "left_semi")
        vol = vol.where(at_or_after(vol, "ts", cal.volume_start))
        loy = flatten_loyalty(world.loyalty_records)
        loy = loy.where(at_or_after(loy, "ts", cal.loyalty_start))
        for source, df in (("volume", vol), ("loyalty", loy)):
            frames.append(latest_month(df, "ts").select(
                F.lit(name).alias("world"), F.lit(source).alias("source"), "*"))
    return _union(frames)


TOTAL_COLS = ("site_id", "year", "trimester", "is_ptd", "volume", "premium_volume",
              "loyalty_volume", "prev_volume", "prev_premium_volume")


def _period_totals(world) -> DataFrame:
    monthly, _, window = period_facts(world, reporting_calendar(world.run_date))
    return period_totals(monthly, window)


def _totals(world) -> DataFrame:
    return _period_totals(world).select(*TOTAL_COLS)


def q_period_closed(spark, sf_dir):
    """Period totals of the closed-period world."""
    return _totals(customer_world(spark, sf_dir))


def q_period_open(spark, sf_dir):
    """Period totals incl. period-to-date of the open-period world."""
    return _totals(supplier_world(spark, sf_dir))


def _fact_stores(spark, world, root):
    """The world's facts as stores of monthly parts: (source, rows, folder)."""
    volume = world.volume_records.select("site_id", "ts", "volume", "premium_volume")
    loyalty = flatten_loyalty(world.loyalty_records).withColumn("loyalty_volume", F.col("loyalty_volume").cast("decimal(22,4)"))
    return ((VOLUME, volume, f"{root}/volume"), (LOYALTY, loyalty, f"{root}/loyalty"))


def q_period_incremental(spark, sf_dir):
    """Period totals of the open-period world from two deliveries of facts. The
    first ends two years early and holds a month twice; the second brings the
    months after and the month corrected. Both runs read new parts only (C6, K1)."""
    world = supplier_world(spark, sf_dir)
    cal = reporting_calendar(world.run_date)
    root = _folder(spark, "facts")
    cut = F.lit(f"{cal.report_year - 1}-01-01").cast("timestamp_ntz")
    wrong = F.date_format("ts", "yyyy-MM") == f"{cal.report_year - 2}-03"
    for source, rows, store in _fact_stores(spark, world, root):
        early = rows.where(F.col("ts") < cut)
        write_facts(early.unionByName(early.where(wrong)), store)
        refresh(spark, store, f"{root}/state", source)
        write_facts(rows.where((F.col("ts") >= cut) | wrong), store)
        refresh(spark, store, f"{root}/state", source)
    return incremental_totals(spark, f"{root}/state", world.roster, cal).select(*TOTAL_COLS)


def q_latest_month_footers(spark, sf_dir):
    """Latest month of each fact from the footers of its store; no row is read (A5)."""
    found = []
    for name, build in WORLDS:
        root = _folder(spark, "facts")
        world = build(spark, sf_dir)
        cal = reporting_calendar(world.run_date)
        for source, rows, store in _fact_stores(spark, world, root):
            # the store holds what counts: volume of roster sites, both facts from their bound on
            bound = cal.volume_start if source == VOLUME else cal.loyalty_start
            rows = rows.where(at_or_after(rows, "ts", bound))
            if source == VOLUME:
                rows = rows.join(world.roster.select("site_id").distinct(), "site_id", "left_semi")
            write_facts(rows, store)
            found.append((name, source, *(latest_stored_month(spark, store) or (None, None))))
    return spark.createDataFrame(found, "world string, source string, max_year long, max_month long")


def q_running_sum(spark, sf_dir):
    """Running volume per site over closed periods."""
    totals = _period_totals(customer_world(spark, sf_dir))
    closed = totals.where(~F.col("is_ptd") & F.col("volume").isNotNull()).select(
        "site_id", "year", "trimester", "volume",
        F.col("volume_exact").alias("_exact"))
    out = running_sum(closed, ["site_id"], ["year", "trimester"], "_exact", "_run")
    return out.select("site_id", "year", "trimester", "volume",
                      F.col("_run").cast("double").alias("running_volume"))


# --- KPIs, points, rank, reports -------------------------------------------

@_per_world
def q_growth_penetration(world, card):
    return card.kpis.select("site_id", "year", "trimester", "is_ptd", "volume_growth",
                            "premium_growth", "penetration")


@_per_world
def q_points_total(world, card):
    return card.scored.select("site_id", "year", "trimester", "is_ptd", "penetration_points",
                              "volume_points", "premium_points", "service_points",
                              "facility_points", "total")


@_per_world
def q_region_rank(world, card):
    return sc_mod.region_rank(card).select("site_id", "region", "owner_name", "year",
                                           "trimester", "is_ptd", "total", "rank")


@_per_world
def q_owner_region_avg(world, card):
    avg = sc_mod.owner_region_averages(card)
    return avg.select("region", "owner_name", "wave_id", _r(F.col("owner_avg")).alias("owner_avg"),
                      _r(F.col("region_avg")).alias("region_avg"))


@_per_world
def q_score_average_sheet(world, card):
    out = sc_mod.score_average_sheet(card)
    return out.select("region", "owner_name", "period", "label", _r(F.col("value")).alias("value"))


def q_scored_wide(spark, sf_dir):
    """Every measure of every scored slot, closed and to date, as columns
    ``<measure>_<yyyyt>`` / ``<measure>_<yyyy>PTD<t>`` beside the site's attributes
    and its rank in the current slot (P7, P8, Z3). The worlds' slots differ: a
    column of the other world is NULL."""
    frames = [wide_scored(card).select(F.lit(name).alias("world"), "*") for name, _, card in _scorecards(spark, sf_dir)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


_MVO = [f"{m}_{g}" for m in ("service", "facility", "experience")
        for g in ("member", "non_member")]


@_per_world
def q_member_vs_other(world, card):
    out = sc_mod.member_vs_other(card, world.assignment)
    return out.select("region", "wave_id", *[_r(F.col(c)).alias(c) for c in _MVO])


@_per_world
def q_owner_vs_region_survey(world, card):
    out = sc_mod.owner_vs_region_survey(card, world.assignment)
    cols = ["service", "facility", "experience", *_MVO]
    return out.select("owner_name", "region", "wave_id", *[_r(F.col(c)).alias(c) for c in cols])


def q_scored_store(spark, sf_dir):
    """The scored table of a second run on the same day, whose sources have gone: it
    scores from the day's committed snapshots, writes the table under its run date
    and reads it back (S12, Z3)."""
    world, folder = supplier_world(spark, sf_dir), _folder(spark, "scored")
    sc_mod.build_scorecard(world, snapshot_root=f"{folder}/pulls")
    gone = replace(world, volume_records=world.volume_records.limit(0), loyalty_records=world.loyalty_records.limit(0), survey_files=[])
    card = sc_mod.build_scorecard(gone, snapshot_root=f"{folder}/pulls")
    return spark.read.parquet(write_scored(card, folder, world.run_date)).select(
        "site_id", "year", "trimester", "is_ptd", "penetration_points", "volume_points", "premium_points",
        "service_points", "facility_points", "total")


def q_report_rows(spark, sf_dir):
    """The ranked report of every (region, owner), written to the report store and read
    back, with the number of files that its index names (Z4, F10, V3)."""
    world = supplier_world(spark, sf_dir)
    card = sc_mod.build_scorecard(world)
    path = write_report_stores(card, world.assignment, _folder(spark, "reports"), world.run_date)["raw"]
    index = spark.read.parquet(f"{path}/{INDEX}").groupBy(*REPORT_KEYS).agg(F.sum("rows").alias("report_rows"))
    return spark.read.parquet(path).join(index, list(REPORT_KEYS)).select(
        "site_id", "region", "owner_name", "total", "rank", "report_rows")


def q_distinct_pairs(spark, sf_dir):
    """Distinct (region, owner) pairs of the roster."""
    world = customer_world(spark, sf_dir)
    sites = sc_mod.enrich_sites(sc_mod.prepare_roster(world.roster), world.hierarchy)
    return sites.select("region", "owner_name").distinct()


def q_hierarchy_enrich(spark, sf_dir):
    """Roster sites with their owner hierarchy."""
    world = customer_world(spark, sf_dir)
    return sc_mod.enrich_sites(sc_mod.prepare_roster(world.roster), world.hierarchy)


def q_title_case_names(spark, sf_dir):
    """Part names in Python title case."""
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_name", title_case("p_name").alias("title_name"))


def q_title_region(spark, sf_dir):
    """Region text of every site, normalised once."""
    world = customer_world(spark, sf_dir)
    return world.hierarchy.select("site_id").join(
        world.roster.select("site_id", F.col("region").alias("raw_region")),
        "site_id").select("site_id", "raw_region",
                          normalise_label("raw_region").alias("region"))


QUERIES: dict[str, Query] = {
    "prices_clean": q_prices_clean,
    "prices_dedupe_first": q_prices_dedupe_first,
    "prices_csv_job": q_prices_csv_job,
    "rejected_rows": q_rejected_rows,
    "pages_class_text": q_pages_class_text,
    "pages_contains": q_pages_contains,
    "pages_body_text": q_pages_body_text,
    "lists_zip": q_lists_zip,
    "layout_union": q_layout_union,
    "survey_ratios": q_survey_ratios,
    "survey_pivot": q_survey_pivot,
    "latest_wave": q_latest_wave,
    "wave_counts": q_wave_counts,
    "crosstab_counts": q_crosstab_counts,
    "crosstab_open": q_crosstab_open,
    "zero_scores": q_zero_scores,
    "log_sizes": q_log_sizes,
    "unpivot_split": q_unpivot_split,
    "pivot_mean": q_pivot_mean,
    "volume_semi_sum": q_volume_semi_sum,
    "volume_by_layout": q_volume_by_layout,
    "loyalty_by_parent": q_loyalty_by_parent,
    "latest_month": q_latest_month,
    "period_closed": q_period_closed,
    "period_open": q_period_open,
    "period_incremental": q_period_incremental,
    "latest_month_footers": q_latest_month_footers,
    "running_sum": q_running_sum,
    "growth_penetration": q_growth_penetration,
    "points_total": q_points_total,
    "region_rank": q_region_rank,
    "owner_region_avg": q_owner_region_avg,
    "score_average_sheet": q_score_average_sheet,
    "member_vs_other": q_member_vs_other,
    "scored_wide": q_scored_wide,
    "owner_vs_region_survey": q_owner_vs_region_survey,
    "scored_store": q_scored_store,
    "report_rows": q_report_rows,
    "distinct_pairs": q_distinct_pairs,
    "hierarchy_enrich": q_hierarchy_enrich,
    "title_case_names": q_title_case_names,
    "title_region": q_title_region,
}
