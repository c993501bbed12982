import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from sitegauge.functions.calendar import PeriodWindow, earliest_window, reporting_calendar, trimester, trimester_of
from sitegauge.functions.columns import (growth, ieee_ratio, last_chars, nan_to_null, normalise_label,
                                         parse_money, split_part, text_month, text_year, title_case)


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_growth_cuts_in_double(spark):
    # FIXTURES 3.3: the cut is compared on the unrounded double.
    rows = [(102.0, 100.0), (101.9, 100.0), (207.0, 200.0), (207.1, 200.0), (5.0, 0.0),
            (0.0, 0.0), (5.0, None), (None, 0.0)]
    got = one(spark, growth("c", "p"), rows, "c double, p double")
    assert got[0] == 102 / 100 - 1 and got[0] >= 0.02
    assert got[1] < 0.02
    assert got[2] == 207 / 200 - 1 and got[2] < 0.035
    assert got[3] >= 0.035
    assert got[4] == math.inf
    assert got[5] is None and got[6] is None and got[7] is None


def test_ieee_ratio_signs(spark):
    got = one(spark, ieee_ratio("n", "d"), [(-1.0, 0.0), (1.0, 4.0), (None, 1.0)], "n double, d double")
    assert got == [-math.inf, 0.25, None]


def test_nan_never_passes_threshold(spark):
    got = one(spark, nan_to_null("v") >= 0.05, [(float("nan"),), (0.06,)], "v double")
    assert got == [None, True]


def test_title_case_like_python(spark):
    texts = [" o'neil-WEST 3rd ", "a-b 3rd", "MIDDLE EAST", "o'neil co", None]
    got = one(spark, title_case("s"), [(t,) for t in texts], "s string")
    assert got[:4] == [t.title() for t in texts[:4]]
    assert one(spark, normalise_label("s"), [(texts[0],)], "s string") == ["O'Neil-West 3Rd"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab-' 3XÉé", max_size=12), min_size=1, max_size=5))
def test_title_case_property(spark, texts):
    got = one(spark, title_case("s"), [(t,) for t in texts], "s string")
    assert got == [t.title() for t in texts]


def test_money_parsing(spark):
    rows = [("$1,299.00",), ("N/A",), ("junk",), (" $5 ",), ("NaN",), ("nan",), ("",), ("Infinity",)]
    got = one(spark, parse_money("s"), rows, "s string")
    assert got == [1299.0, None, None, 5.0, None, None, None, float("inf")]


def test_text_slices_and_split(spark):
    df = spark.createDataFrame([("2018-07-15T00:00", "service_20182", "abc")], "d string, v string, s string")
    r = df.select(text_year("d"), text_month("d"), split_part("v", "_", 1), split_part("v", "_", 2),
                  split_part("v", "_", 3), last_chars("v", 5), last_chars("s", 5)).first()
    assert list(r) == [2018, 7, "service", "20182", "", "20182", "abc"]


def test_trimester_all_months(spark):
    got = one(spark, trimester("m"), [(m,) for m in range(1, 13)], "m int")
    assert got == [(m + 3) // 4 for m in range(1, 13)] == [trimester_of(m) for m in range(1, 13)]


@given(st.dates(min_value=dt.date(2000, 1, 1), max_value=dt.date(2100, 12, 31)))
def test_reporting_calendar_previous_month(d):
    cal = reporting_calendar(d)
    prev = d.replace(day=1) - dt.timedelta(days=1)
    assert (cal.report_year, cal.report_month) == (prev.year, prev.month)
    assert cal.previous_year == cal.report_year - 1
    assert cal.volume_start == dt.date(cal.report_year - 2, 1, 1)


def test_february_run_is_january(spark):
    # D3: a February run reports January of the same year, not December.
    cal = reporting_calendar(dt.date(2019, 2, 5))
    assert (cal.report_year, cal.report_month) == (2019, 1)


def test_period_windows():
    # FIXTURES 3.2
    cases = {3: (True, 0), 7: (True, 4), 8: (False, 8), 11: (True, 8), 12: (False, 12)}
    for m, (is_open, ppe) in cases.items():
        w = PeriodWindow(2018, m)
        assert w.is_open == is_open and w.prev_period_end == ppe and w.label == (m + 3) // 4
    assert earliest_window((2018, 7), (2018, 8)) == PeriodWindow(2018, 7)
    assert earliest_window(None, (2018, 8)) == PeriodWindow(2018, 8)
    assert earliest_window(None, None) is None


def test_penetration_bands(spark):
    # FIXTURES 3.3: loyalty / volume at the band edges, computed in double
    from sitegauge.plans.scorecard import penetration_points
    rows = [(5.0, 100.0), (9.99, 100.0), (10.0, 100.0), (4.99, 100.0), (None, 100.0), (1.0, 0.0)]
    got = one(spark, penetration_points(ieee_ratio("l", "v")), rows, "l double, v double")
    assert got == [25, 25, 30, 0, 0, 30]


def test_period_label_override():
    w = PeriodWindow(2018, 5, label_override=3)
    assert w.label == 3 and w.prev_period_end == 4 and w.is_open
