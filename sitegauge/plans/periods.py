"""Period totals: the fact tables turned into sums per site and period
(S9, S10, A1-A3, A5, C3, C6, C7, J5, J11, J12).

Long format is the core model: one row per
``(site_id, year, trimester, is_ptd)`` instead of run-time-named columns.

How the reference's two pivots map here:

* closed periods (C7): every row counts toward its own (year, trimester),
  except, when the latest period is still open, the open months of the
  latest year;
* open period to date (C6): the open months of the last two years count
  toward (year, label) with ``is_ptd = true``. Prior-year open months feed
  both outputs.

Each monthly row is tagged with every output it feeds (``explode`` of at most
four tags) and also with the following year's "previous" slot, so a single
``groupBy`` yields current and previous-year sums side by side: growth needs
no self-join and no window. All sums are DECIMAL (exact, order-independent)
and become double only at the end.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegauge.functions.calendar import (PERIODS_PER_YEAR, PeriodWindow, ReportingCalendar,
                                          earliest_window, trimester)
from sitegauge.operators.aggregates import zero_sum
from sitegauge.operators.joins import existence_flag, semi_join
from sitegauge.session import freeze

VOLUME, LOYALTY = "volume", "loyalty"


def at_or_after(df: DataFrame, col: str, day: dt.date) -> Column:
    """``col >= day`` written as a range on the raw column, typed like the
    column, so Parquet receives it as a pushed filter (trap T14)."""
    typ = df.schema[col].dataType
    lit = F.lit(day.isoformat())
    if isinstance(typ, T.TimestampNTZType):
        lit = lit.cast("timestamp_ntz")
    elif isinstance(typ, T.TimestampType):
        lit = lit.cast("timestamp")
    elif isinstance(typ, T.DateType):
        lit = lit.cast("date")
    return F.col(col) >= lit


def flatten_loyalty(records: DataFrame) -> DataFrame:
    """Child -> parent key traversal of the loyalty records."""
    return records.select(
        F.col("location_master.location_number").alias("site_id"),
        F.col("ts"), F.col("loyalty_volume"))


def daily_volume(records: DataFrame, roster: DataFrame, start: dt.date) -> DataFrame:
    """Volume and premium volume per (site, day) for roster sites, from
    ``start`` on (S9, A3, J11): one set-based job instead of a query per site.

    The roster keys are de-duplicated (D9). (site, day) is nearly unique, so the
    semi-join comes before the sums; its strategy is left to the planner.
    """
    kept = semi_join(records.where(at_or_after(records, "ts", start)), roster, "site_id")
    daily = (kept.groupBy("site_id", F.to_date("ts").alias("day"))
             .agg(zero_sum("volume").alias("volume"),
                  zero_sum("premium_volume").alias("premium_volume")))
    return daily.select(
        "site_id", "day",
        F.col("volume").cast("double").alias("volume"),
        F.col("premium_volume").cast("double").alias("premium_volume"))


def monthly_facts(volume_records: DataFrame, loyalty_records: DataFrame,
                  roster: DataFrame, calendar: ReportingCalendar) -> DataFrame:
    """Both facts summed per (site, year, month, source) in one aggregate.

    Volume counts only for roster sites (the reference queries volume per
    roster site), loyalty for every site (its query has no site filter), so
    "a period exists" is decided on the same rows as in the reference.
    Aggregating before the roster join keeps the shuffle at one partial sum
    per (site, month) per task, whatever the skew of the raw records.
    """
    vol = volume_records.where(at_or_after(volume_records, "ts", calendar.volume_start)).select(
        "site_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.lit(VOLUME).alias("source"), "volume", "premium_volume",
        F.lit(None).cast("decimal(21,4)").alias("loyalty_volume"))
    loy_flat = flatten_loyalty(loyalty_records)
    loy = loy_flat.where(at_or_after(loy_flat, "ts", calendar.loyalty_start)).select(
        "site_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.lit(LOYALTY).alias("source"),
        F.lit(None).cast("decimal(18,2)").alias("volume"),
        F.lit(None).cast("decimal(18,2)").alias("premium_volume"),
        "loyalty_volume")
    monthly = (vol.unionByName(loy)
               .groupBy("site_id", "year", "month", "source")
               .agg(F.sum("volume").alias("volume"),
                    F.sum("premium_volume").alias("premium_volume"),
                    F.sum("loyalty_volume").alias("loyalty_volume"),
                    F.count(F.lit(1)).alias("n_rows")))
    return roster_months(monthly, roster)


def roster_months(monthly: DataFrame, roster: DataFrame) -> DataFrame:
    """Monthly sums that count: volume of roster sites, loyalty of every site."""
    flagged = existence_flag(monthly, roster, "site_id", "_member")
    return flagged.where((F.col("source") == LOYALTY) | (F.col("_member") == 1)).drop("_member")


def present_months(monthly: DataFrame) -> set[tuple[str, int, int]]:
    """The (source, year, month) triples that have at least one fact row.

    One small read, bounded by the calendar (sources x months), that decides
    both the data window and which period slots exist."""
    rows = monthly.select("source", "year", "month").distinct().collect()
    return {(r["source"], int(r["year"]), int(r["month"])) for r in rows}


def latest_by_source(months: set[tuple[str, int, int]]) -> dict[str, tuple[int, int]]:
    """Latest (year, month) of each fact (A5)."""
    latest: dict[str, tuple[int, int]] = {}
    for src, y, m in months:
        latest[src] = max(latest.get(src, (y, m)), (y, m))
    return latest


def data_window(months: set[tuple[str, int, int]]) -> PeriodWindow | None:
    """Latest month per fact (A5), then the earlier of the two."""
    latest = latest_by_source(months)
    return earliest_window(latest.get(VOLUME), latest.get(LOYALTY))


def _tags(window: PeriodWindow) -> Column:
    """Every output slot a monthly row feeds: (year, trimester, is_ptd, role); NULL
    for one that it doesn't."""
    y, m = F.col("year"), F.col("month")
    Y, M, ppe, label = window.max_year, window.max_month, window.prev_period_end, window.label

    # Slot keys are produced as long, the type of every downstream join key,
    # so the totals keep the partitioning of their aggregate into the joins.
    def tag(year: Column, trim: Column, ptd: bool, role: str) -> Column:
        return F.struct(year.cast("long").alias("p_year"), trim.cast("long").alias("p_trim"),
                        F.lit(ptd).alias("is_ptd"), F.lit(role).alias("role"))

    trim = trimester(m)
    closed = ~((y == Y) & (m > ppe)) if window.is_open else F.lit(True)
    tags = [
        F.when(closed, tag(y, trim, False, "cur")),
        F.when(closed & (y + 1 >= Y - 1) & (y + 1 <= Y), tag(y + 1, trim, False, "prev")),
    ]
    if window.is_open:
        ptd = y.isin(Y - 1, Y) & (m > ppe) & (m <= M)
        tags += [F.when(ptd, tag(y, F.lit(label), True, "cur")),
                 F.when(ptd & (y == Y - 1), tag(F.lit(Y), F.lit(label), True, "prev"))]
    return F.array(*tags)


def period_totals(monthly: DataFrame, window: PeriodWindow) -> DataFrame:
    """Sums per (site, year, trimester, is_ptd) with previous-year sums beside
    them. A measure is NULL where its fact has no row for that site and
    period, 0 where rows exist but are all NULL (trap T3)."""
    tagged = monthly.select("*", F.explode(_tags(window)).alias("t")).where(F.col("t").isNotNull())
    cur, prev = F.col("t.role") == "cur", F.col("t.role") == "prev"
    is_vol, is_loy = F.col("source") == VOLUME, F.col("source") == LOYALTY

    def part(cond, measure):
        return F.when(cond, F.col(measure))

    def rows(cond):
        return F.sum(F.when(cond, F.col("n_rows")).otherwise(F.lit(0)))

    sums = (tagged.groupBy("site_id", F.col("t.p_year").alias("year"),
                           F.col("t.p_trim").alias("trimester"), F.col("t.is_ptd").alias("is_ptd"))
            .agg(F.sum(part(cur, "volume")).alias("volume"),
                 F.sum(part(cur, "premium_volume")).alias("premium_volume"),
                 F.sum(part(cur, "loyalty_volume")).alias("loyalty_volume"),
                 F.sum(part(prev, "volume")).alias("prev_volume"),
                 F.sum(part(prev, "premium_volume")).alias("prev_premium_volume"),
                 rows(cur & is_vol).alias("n_volume"),
                 rows(cur & is_loy).alias("n_loyalty"),
                 rows(prev & is_vol).alias("n_prev_volume")))

    def measure(name, n):
        return F.when(F.col(n) > 0, F.coalesce(F.col(name), F.lit(0))).cast("double").alias(name)

    return sums.select(
        "site_id", F.col("year").cast("long").alias("year"),
        F.col("trimester").cast("long").alias("trimester"), "is_ptd",
        measure("volume", "n_volume"), measure("premium_volume", "n_volume"),
        measure("loyalty_volume", "n_loyalty"),
        measure("prev_volume", "n_prev_volume"),
        measure("prev_premium_volume", "n_prev_volume"),
        F.col("n_volume"), F.col("n_loyalty"), F.col("n_prev_volume"),
        F.col("volume").alias("volume_exact"))


@dataclass(frozen=True)
class Pair:
    """One (year, trimester, is_ptd) slot with the KPI blocks that run for it."""

    year: int
    trimester: int
    is_ptd: bool
    growth_ok: bool
    pen_ok: bool
    score_ok: bool

    @property
    def wave_id(self) -> str:
        return f"{self.year}{self.trimester}"


@dataclass
class PeriodPlan:
    window: PeriodWindow | None
    present: set = field(default_factory=set)    # (source, year, trim, is_ptd)
    pairs: list = field(default_factory=list)    # [Pair]
    latest: dict = field(default_factory=dict)   # source -> (year, month)

    @property
    def facts_disagree(self) -> bool:
        """The facts end in different months (D4): the window uses the
        earlier one, and the later months of the other fact are not scored."""
        return len(set(self.latest.values())) > 1

    @property
    def current(self) -> Pair | None:
        """The pair that is ranked: the open period-to-date if the period is
        open, else the latest closed trimester."""
        if self.window is None:
            return None
        for p in self.pairs:
            if (p.year, p.trimester, p.is_ptd) == (
                    self.window.max_year, self.window.label, self.window.is_open) and p.score_ok:
                return p
        return None


def plan_pairs(months: set[tuple[str, int, int]], window: PeriodWindow | None,
               survey_waves: set[str]) -> PeriodPlan:
    """Which KPI and score blocks can run (K4, K7): the reference skips a
    (year, period) as a whole when any input column is missing, i.e. when a
    fact has no row at all in the months that feed that slot. Decided from
    the months present, with the same tagging rules as :func:`_tags`."""
    if window is None:
        return PeriodPlan(None)
    Y, M, ppe, label = window.max_year, window.max_month, window.prev_period_end, window.label

    def has(src, y, t, ptd):
        if ptd:
            feeds = [m for m in range(ppe + 1, M + 1)] if (
                window.is_open and t == label and y in (Y - 1, Y)) else []
        else:
            feeds = [m for m in range(4 * t - 3, 4 * t + 1)
                     if not (window.is_open and y == Y and m > ppe)]
        return any((src, y, m) in months for m in feeds)

    present = {(src, y, t, ptd) for src in (VOLUME, LOYALTY) for y in range(Y - 2, Y + 1)
               for t in range(1, PERIODS_PER_YEAR + 1) for ptd in (False, True)
               if has(src, y, t, ptd)}
    pairs = []
    if window.is_open:
        t = label
        g = has(VOLUME, Y, t, True) and has(VOLUME, Y - 1, t, True)
        p = g and has(LOYALTY, Y, t, True)
        if g:
            pairs.append(Pair(Y, t, True, g, p, g and p and f"{Y}{t}" in survey_waves))
    for y in window.kpi_years():
        for t in range(1, PERIODS_PER_YEAR + 1):
            ok = (has(VOLUME, y, t, False) and has(VOLUME, y - 1, t, False)
                  and has(LOYALTY, y, t, False))
            if ok:
                pairs.append(Pair(y, t, False, True, True, f"{y}{t}" in survey_waves))
    return PeriodPlan(window, present, pairs, latest_by_source(months))


def period_facts(world, calendar: ReportingCalendar, period_label: int | None = None):
    """Monthly facts of a world, frozen (they feed the window decision, the
    slot plan and the main plan), the months present and the window.
    ``period_label`` overrides the data-derived period number (D2)."""
    monthly = freeze(monthly_facts(world.volume_records, world.loyalty_records,
                                   world.roster, calendar), "monthly")
    months = present_months(monthly)
    return monthly, months, window_of(months, period_label)


def window_of(months: set[tuple[str, int, int]], period_label: int | None = None):
    """The data window, with the period label overridden if asked."""
    window = data_window(months)
    if window is not None and period_label is not None:
        window = replace(window, label_override=period_label)
    return window
