"""Property tests."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitegauge.operators.dedupe import keep_first
from sitegauge.operators.reshape import melt, strict_pivot
from sitegauge.plans.scorecard import score_table
from sitegauge.plans.survey_scores import survey_ratios

ANSWER = st.sampled_from(["Yes", "Caution", "No", "yes", None])
Q = ["q7", "q8", "q9", "q10", "q11", "q12", "q14", "q18"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(*[ANSWER] * 8), min_size=1, max_size=40))
def test_ratio_bounds(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{q} string" for q in Q))
    for r in survey_ratios(df).collect():
        if r["q18"] is not None:
            assert 0 <= r["service_num"] <= r["service_den"]
        if r["q14"] is not None:
            assert 0 <= r["facility_num"] <= r["facility_den"]
        assert r["facility_ratio"] is None or 0 <= r["facility_ratio"] <= 1
        if r["facility_den"] == 0:
            assert r["facility_ratio"] is None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["d1", "d2"]), st.integers(0, 9)),
                min_size=1, max_size=40))
def test_keep_first_idempotent_and_minimal(spark, rows):
    data = [(k, d, v, i) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d string, v int, seq long")
    once = keep_first(df, ["k", "d"], ["seq"])
    twice = keep_first(once, ["k", "d"], ["seq"])
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    expected = {}
    for k, d, v, i in data:
        expected.setdefault((k, d), (k, d, v, i))
    assert a == sorted(expected.values())


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.sampled_from(["20181", "20182"])),
                       st.one_of(st.none(), st.floats(0, 1)), min_size=1, max_size=6))
def test_unpivot_of_pivot_is_identity(spark, cells):
    data = [(s, w, v) for (s, w), v in cells.items()]
    df = spark.createDataFrame(data, "site string, wave string, m double")
    waves = ["20181", "20182"]
    wide = strict_pivot(df, ["site"], "wave", waves, ["m"])
    long = melt(wide, ["site"], [f"m_{w}" for w in waves]).select(
        "site", F.substring("variable", 3, 5).alias("wave"), F.col("value").alias("m"))
    back = {(r["site"], r["wave"]): r["m"] for r in long.collect()}
    for (s, w), v in cells.items():
        assert back[(s, w)] == v
    present = {s for s, _ in cells}
    assert all(back[(s, w)] is None for s in present for w in waves if (s, w) not in cells)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-1, 10)), st.one_of(st.none(), st.floats(-1, 10)),
                          st.one_of(st.none(), st.floats(0, 1)), st.floats(0, 1), st.floats(0, 1)),
                min_size=1, max_size=20))
def test_total_within_0_100(spark, rows):
    data = [(f"s{i}", 2018, 2, True, True, g, pg, pen) for i, (g, pg, pen, _, _) in enumerate(rows)]
    kpis = spark.createDataFrame(data, "site_id string, year long, trimester long, is_ptd boolean, "
                                       "score_ok boolean, volume_growth double, premium_growth double, "
                                       "penetration double")
    survey = spark.createDataFrame([(f"s{i}", "20182", s, f, 50.0) for i, (*_, s, f) in enumerate(rows)],
                                   "site_id string, wave_id string, service_ratio double, "
                                   "facility_ratio double, experience_score double")
    for r in score_table(kpis, survey).collect():
        assert 0 <= r["total"] <= 100
