"""Reporting calendar and period window.

Pure functions of the run date or of the latest data month: parameters in,
literals out. Nothing here reads the clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring calendar: a year has three four-month periods.
MONTHS_PER_PERIOD = 4
PERIODS_PER_YEAR = 3


def trimester(month: str | Column) -> Column:
    """Four-month period of a month: 1-4 -> 1, 5-8 -> 2, 9-12 -> 3 (C4)."""
    m = F.col(month) if isinstance(month, str) else month
    return ((m + (MONTHS_PER_PERIOD - 1)).cast("int") / MONTHS_PER_PERIOD).cast("int")


def trimester_of(month: int) -> int:
    return (month + MONTHS_PER_PERIOD - 1) // MONTHS_PER_PERIOD


def wave_id(year: int, period: int) -> str:
    """Survey wave / period label ``yyyy`` + period digit, e.g. ``20182``."""
    return f"{year}{period}"


@dataclass(frozen=True)
class ReportingCalendar:
    """Dates derived from the run date (C8, with defects D2/D3 resolved).

    The report month is always the previous calendar month; both years derive
    from it. ``run_period`` is the run-date label (cut points 5/9) kept for
    reference; scoring uses the data-driven label of :class:`PeriodWindow`.
    """

    run_date: dt.date
    report_year: int
    report_month: int
    run_period: int

    @property
    def previous_year(self) -> int:
        return self.report_year - 1

    @property
    def volume_start(self) -> dt.date:
        """Lower scan bound of volume facts: Jan 1 two years back."""
        return dt.date(self.report_year - 2, 1, 1)

    @property
    def loyalty_start(self) -> dt.date:
        """Lower scan bound of loyalty facts: Jan 1 of the previous year."""
        return dt.date(self.previous_year, 1, 1)

    @property
    def window_start(self) -> dt.date:
        return dt.date(self.report_year, 1, 1)

    @property
    def window_end(self) -> dt.date:
        return dt.date(self.report_year, self.report_month, 1)

    def report_years(self) -> tuple[int, int]:
        return (self.previous_year, self.report_year)


def reporting_calendar(run_date: dt.date) -> ReportingCalendar:
    first = run_date.replace(day=1)
    prev = first - dt.timedelta(days=1)
    pmon = prev.month
    run_period = 1 if pmon <= 5 else (2 if pmon <= 9 else 3)
    return ReportingCalendar(run_date, prev.year, pmon, run_period)


@dataclass(frozen=True)
class PeriodWindow:
    """Latest data month and the open/closed period decision.

    If the latest month does not end a period, the period is *open*: months
    ``prev_period_end + 1 .. max_month`` of the last two years form the
    period-to-date (PTD) comparison, and the label is that period's number.
    """

    max_year: int
    max_month: int
    label_override: int | None = None   # D2: a caller-chosen period label

    @property
    def is_open(self) -> bool:
        return self.max_month % MONTHS_PER_PERIOD != 0

    @property
    def prev_period_end(self) -> int:
        if self.is_open:
            return self.max_month // MONTHS_PER_PERIOD * MONTHS_PER_PERIOD
        return self.max_month

    @property
    def label(self) -> int:
        """Period number of the open (or last closed) period: the trimester of
        the latest data month unless overridden."""
        if self.label_override is not None:
            return self.label_override
        return trimester_of(self.max_month)

    def kpi_years(self) -> tuple[int, int]:
        return (self.max_year - 1, self.max_year)


def earliest_window(*months: tuple[int, int] | None) -> PeriodWindow | None:
    """One window per run: the earlier of the facts' latest months."""
    present = [m for m in months if m is not None]
    if not present:
        return None
    y, m = min(present)
    return PeriodWindow(y, m)
