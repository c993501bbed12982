import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitegauge.operators.aggregates import (contingency, latest_month, mean_by, money_sum, open_contingency,
                                            zero_sum)
from sitegauge.operators.dedupe import assert_unique, keep_first, keep_first_late, latest_per_key
from sitegauge.operators.joins import (existence_flag, not_equal_keep_null,
                                       null_safe_left_join, semi_join)
from sitegauge.operators.ranking import rank_within, running_sum, sort_nulls_last
from sitegauge.operators.reshape import mean_pivot, melt, strict_pivot


def test_keep_first_by_ingest_order(spark):
    # FIXTURES 3.4 keep first: seq 1 and 3 survive
    df = spark.createDataFrame([("A", "08/26", 10.0, 1), ("A", "08/26", 12.0, 2), ("A", "08/27", 11.0, 3)],
                               "product string, date string, price double, seq long")
    got = sorted(tuple(r) for r in keep_first(df, ["product", "date"], ["seq"]).collect())
    assert got == [("A", "08/26", 10.0, 1), ("A", "08/27", 11.0, 3)]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_late_keep_first_equals_keep_first(spark, threshold):
    """Ties on the first order column, NULL keys and orders, a hot key, with the
    repeated keys broadcast and shuffled."""
    n = F.col("id")
    rows = spark.range(0, 3000, 1, 6).select(
        F.when(n % 3 == 0, F.lit("hot")).when(n % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (n % 1700).cast("string"))).alias("k"),
        F.when(n % 7 != 0, (n % 2).cast("int")).alias("d"), F.when(n % 11 != 0, -(n % 5)).alias("o1"), F.xxhash64(n).alias("o2"),
        F.concat(F.lit("payload "), n.cast("string")).alias("v"), (n * 0.5).alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        late = keep_first_late(rows, ["k", "d"], ["o1", "o2"], keep=["k", "d", "v", "w"])
        want = keep_first(rows, ["k", "d"], ["o1", "o2"], keep=["v", "w"])
        assert late.columns == want.columns == ["k", "d", "v", "w"]
        assert sorted(map(str, late.collect())) == sorted(map(str, want.collect()))
        assert keep_first_late(rows.limit(0), ["k"], ["o1"]).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_late_keep_first_with_shared_marks(spark, monkeypatch):
    """Repeated keys meet their rows by four bytes; keys that share a mark stay apart."""
    from sitegauge.operators import dedupe
    rows = spark.range(0, 200, 1, 4).select((F.col("id") % 150).cast("string").alias("k"), F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    marks = dedupe.repeated_marks(rows, ["k"])
    assert marks.dtypes == [("_mark", "int")] and marks.count() == 50
    want = sorted(map(str, keep_first(rows, ["k"], ["o"], keep=["v"]).collect()))
    every = marks.first()[0]
    monkeypatch.setattr(dedupe, "_mark", lambda keys: F.lit(every))
    assert sorted(map(str, keep_first_late(rows, ["k"], ["o"], keep=["k", "v"]).collect())) == want


def test_keep_first_hot_key_many_partitions(spark):
    # one key holds most rows, spread over many input partitions
    df = spark.range(0, 20000, numPartitions=16).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    got = {r["k"]: r["v"] for r in keep_first(df, ["k"], ["seq"]).collect()}
    assert got["hot"] == 0 and len(got) == 1 + 4000


def test_latest_manager(spark):
    df = spark.createDataFrame([("s1", "20172", "M1"), ("s1", "20182", "M2")],
                               "site_id string, wave_id string, territory_manager string")
    r = latest_per_key(df, "site_id", "wave_id", ["territory_manager"]).first()
    assert (r["wave_id"], r["territory_manager"]) == ("20182", "M2")


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        assert_unique(df, ["k"])
    assert assert_unique(df.limit(1), ["k"]).count() == 1


def test_rank_fixture(spark):
    # FIXTURES 3.4 rank: 90, 90, null, 70 -> 1, 2, 4, 3 (tie by site id); null region -> null rank
    df = spark.createDataFrame([("a", "N", 90.0), ("b", "N", 90.0), ("c", "N", None), ("d", "N", 70.0),
                                ("e", None, 50.0)], "site_id string, region string, total double")
    got = {r["site_id"]: r["rank"] for r in rank_within(
        df, ["region"], [F.col("total").desc_nulls_last(), F.col("site_id")]).collect()}
    assert got == {"a": 1, "b": 2, "c": 4, "d": 3, "e": None}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["N", "S", "E"]), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=60))
def test_rank_is_row_number(spark, rows):
    data = [(f"s{i:03d}", g, None if v is None else float(v)) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "site_id string, region string, total double")
    got = {r["site_id"]: r["rank"] for r in rank_within(
        df, ["region"], [F.col("total").desc_nulls_last(), F.col("site_id")], slices=5).collect()}
    for g in ("N", "S", "E"):
        members = sorted((d for d in data if d[1] == g),
                         key=lambda d: (d[2] is None, -(d[2] or 0), d[0]))
        assert [got[d[0]] for d in members] == list(range(1, len(members) + 1))


def test_rank_hot_region_spread(spark):
    df = spark.range(0, 5000, numPartitions=8).select(
        F.format_string("s%05d", "id").alias("site_id"),
        F.when(F.col("id") < 4000, F.lit("HOT")).otherwise(F.lit("COLD")).alias("region"),
        (F.col("id") % 97).cast("double").alias("total"))
    ranked = rank_within(df, ["region"], [F.col("total").desc_nulls_last(), F.col("site_id")], slices=8)
    r = ranked.groupBy("region").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).collect()
    assert {x[0]: tuple(x[1:]) for x in r} == {"HOT": (1, 4000, 4000), "COLD": (1, 1000, 1000)}


def test_running_sum(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 5.0)], "k string, t int, v double")
    got = sorted(tuple(r) for r in running_sum(df, ["k"], ["t"], "v", "run").collect())
    assert got == [("a", 1, 1.0, 1.0), ("a", 2, 2.0, 3.0), ("b", 1, 5.0, 5.0)]


def test_sort_nulls_last_both_directions(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None), ("a", 2.0), ("b", 3.0)], "g string, v double")
    got = [tuple(r) for r in sort_nulls_last(df, ["g", "v"], [True, False]).collect()]
    assert got == [("a", 2.0), ("a", None), ("b", 3.0), (None, 1.0)]


def test_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("North",), (None,), ("SKIP FOR NOW",)], "region string")
    assert [r[0] for r in df.where(not_equal_keep_null("region", "SKIP FOR NOW")).collect()] == ["North", None]


def test_null_safe_join_and_flags(spark):
    left = spark.createDataFrame([("s1", "M1"), ("s2", None)], "site_id string, tm string")
    right = spark.createDataFrame([("M1", "North"), (None, "Nowhere")], "tm string, region string")
    got = {r["site_id"]: r["region"] for r in null_safe_left_join(left, right, ["tm"]).collect()}
    assert got == {"s1": "North", "s2": "Nowhere"}
    roster = spark.createDataFrame([("s1",), ("s1",)], "site_id string")
    flags = {r["site_id"]: r["m"] for r in existence_flag(left, roster, "site_id", "m").collect()}
    assert flags == {"s1": 1, "s2": 0}
    assert semi_join(left, roster, "site_id").count() == 1


def test_full_outer_coalesces_key(spark):
    a = spark.createDataFrame([("p", 1.0)], "site_id string, ptd double")
    b = spark.createDataFrame([("c", 2.0)], "site_id string, closed double")
    got = sorted(tuple(r) for r in a.join(b, ["site_id"], "full").collect())
    assert got == [("c", None, 2.0), ("p", 1.0, None)]


def test_sums_and_means_pandas_rules(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.5), (None, 9.0)], "k string, v double")
    sums = {r[0]: r[1] for r in df.groupBy("k").agg(zero_sum("v")).collect()}
    assert sums["a"] == 0 and sums["b"] == 1.5
    means = {r["k"]: r["v"] for r in mean_by(df, ["k"], ["v"]).collect()}
    assert set(means) == {"a", "b"} and means["a"] is None
    assert df.agg(money_sum("v")).first()[0] == 10.5


def test_latest_month_and_contingency(spark):
    df = spark.createDataFrame([("2018-07-31",), ("2017-12-01",)], "d string").select(F.to_date("d").alias("d"))
    r = latest_month(df, "d").first()
    assert (r["max_year"], r["max_month"]) == (2018, 7)
    ct = spark.createDataFrame([(21, 0), (21, 21), (15, 12), (None, 3)], "den int, num int")
    got = {r["den"]: tuple(r[1:]) for r in contingency(ct, "den", "num", [0, 12, 21], null_label="nan").collect()}
    assert got["21"] == (1, 0, 1, 0) and got["nan"] == (0, 0, 0, 0)


def test_strict_pivot_names_and_duplicates(spark):
    df = spark.createDataFrame([("s1", "20181", 0.5, 1.0), ("s1", "20182", 0.7, None)],
                               "site string, wave string, service double, facility double")
    wide = strict_pivot(df, ["site"], "wave", ["20181", "20182"], ["service", "facility"])
    assert wide.columns == ["site", "service_20181", "facility_20181", "service_20182", "facility_20182"]
    assert tuple(wide.first()) == ("s1", 0.5, 1.0, 0.7, None)
    dup = df.union(df.limit(1))
    with pytest.raises(PySparkException):
        strict_pivot(dup, ["site"], "wave", ["20181", "20182"], ["service"]).collect()


def test_melt_keeps_nulls_and_pivot_mean(spark):
    wide = spark.createDataFrame([("s1", 1, None), ("s2", 3, 4.0)], "site string, a int, b double")
    long = melt(wide, ["site"], ["a", "b"])
    assert long.count() == 4 and long.where(F.col("value").isNull()).count() == 1
    m = mean_pivot(long.withColumn("g", F.lit("x")), ["g"], "variable", ["a", "b"])
    assert tuple(m.first()) == ("x", 2.0, 4.0)


def test_hot_region_is_split_over_slices(spark):
    df = spark.range(0, 8000, numPartitions=8).select(
        F.format_string("s%05d", "id").alias("site_id"),
        F.when(F.col("id") % 5 != 0, F.lit("HOT")).otherwise(F.lit("COLD")).alias("region"),
        ((F.col("id") * 7919) % 1000).cast("double").alias("total"))
    ranked = rank_within(df, ["region"], [F.col("total").desc_nulls_last(), F.col("site_id")],
                         slices=8, slice_out="slice")
    per_slice = {r["slice"]: r["n"] for r in ranked.where("region = 'HOT'")
                 .groupBy("slice").agg(F.count("*").alias("n")).collect()}
    assert len(per_slice) >= 6                      # the hot region spans most slices
    assert max(per_slice.values()) <= 2 * 8000 / 8  # no slice holds much more than its share


def test_strict_pivot_checks_whatever_is_read(spark):
    rows = spark.createDataFrame([("a", "20181", 1.0), ("a", "20181", 2.0), ("b", "20182", 3.0)],
                                 "site string, wave string, m double")
    wide = strict_pivot(rows, ["site"], "wave", ["20181", "20182"], ["m"])
    for read in (wide.count, wide.select("m_20182").collect, wide.select("site").collect):
        with pytest.raises(Exception, match="duplicate"):
            read()
    other = strict_pivot(rows.where("site = 'b'"), ["site"], "wave", ["20181"], ["m"])
    with pytest.raises(Exception, match="outside the list"):
        other.count()


def test_no_value_vanishes_from_tables(spark):
    rows = [("a", "x"), ("a", "y"), ("a", None), (None, "x"), ("b", "z"), ("b", "z"), ("b", "missing"), ("b", "other")]
    df = spark.createDataFrame(rows, "r string, c string")
    got = {r["r"]: r.asDict() for r in open_contingency(df, "r", "c").collect()}
    assert got["a"] == {"r": "a", "n_missing": 0, "n_other": 0, "n_x": 1, "n_y": 1, "n_z": 0, "other": 0, "missing": 1, "total": 3}
    assert sum(r["total"] for r in got.values()) == len(rows) and got[None]["n_x"] == 1
    tail = {r["r"]: r for r in open_contingency(df.where("c is null or c not in ('missing', 'other')"), "r", "c", most=1).collect()}
    assert tail["a"].asDict() == {"r": "a", "n_x": 1, "other": 1, "missing": 1, "total": 3}
    assert tail["b"].asDict() == {"r": "b", "n_x": 0, "other": 2, "missing": 0, "total": 2}
    with pytest.raises(PySparkException, match="outside the list"):
        contingency(df, "r", "c", ["x", "y"], strict=True).collect()
    assert {r["r"]: r["n_x"] for r in contingency(df.where("c = 'x' or c is null"), "r", "c", ["x", "y"], strict=True).collect()} == {"a": 1, None: 1}
    with pytest.raises(PySparkException, match="outside the list"):
        mean_pivot(df.withColumn("v", F.lit(1.0)), ["r"], "c", ["x"], "v").collect()
    assert open_contingency(df.limit(0), "r", "c").count() == 0
