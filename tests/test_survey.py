import pytest

from sitegauge.plans.survey_scores import survey_ratios
from sitegauge.sources.survey import normalise_files

Q = ["q7", "q8", "q9", "q10", "q11", "q12", "q14", "q18"]
SCHEMA = ", ".join(f"{q} string" for q in Q)


def ratios(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return [r.asDict() for r in survey_ratios(df).collect()]


def test_service_ratio_cases(spark):
    # FIXTURES 3.1 a-e: (Q10, Q11, Q12, Q18) -> num, den
    cases = [(("Yes", "Yes", "Yes", "Yes"), 21, 21), (("Yes", "Caution", None, "Yes"), 12, 15),
             ((None, None, None, "Yes"), 3, 3), ((None, None, None, None), 0, 3),
             (("yes", "CAUTION", "No", "Caution"), 0, 21)]
    rows = [("Yes",) * 3 + c[:3] + ("Yes", c[3]) for c, _, _ in cases]
    got = ratios(spark, rows)
    for g, (_, num, den) in zip(got, cases):
        assert (g["service_num"], g["service_den"]) == (num, den)
        assert g["service_ratio"] == num / den


def test_facility_ratio_cases(spark):
    # FIXTURES 3.1 f-h: (Q7, Q8, Q9, Q14); all missing -> 0/0 -> NULL
    cases = [(("Yes", "Yes", "Caution", None), 15, 18), ((None, None, None, None), 0, 0),
             ((None, None, None, "Caution"), 0, 3)]
    rows = [c[:3] + ("Yes", "Yes", "Yes", c[3], "Yes") for c, _, _ in cases]
    got = ratios(spark, rows)
    assert [(g["facility_num"], g["facility_den"]) for g in got] == [(n, d) for _, n, d in cases]
    assert got[0]["facility_ratio"] == 15 / 18
    assert got[1]["facility_ratio"] is None
    assert got[2]["facility_ratio"] == 0.0


def _legacy(spark):
    return spark.createDataFrame(
        [(101, 20171, "TM1", "SM1", "Yes", "Yes", "Yes", "Yes", "Yes", "Yes", "Caution", "No", 80.0)],
        "LocationCode long, WavId long, `Territory Manager` string, `Sales Manager` string, "
        "Q7_Response string, Q8_Response string, Q9_Response string, Q10_Response string, "
        "Q11_Response string, Q12_Response string, Q15_Response string, Q19_Response string, SEScore double")


def _current(spark):
    return spark.createDataFrame(
        [("102", "20182", "TM2", "SM2", "No", None, "Yes", "Yes", "Yes", "Yes", "Yes", "Yes", 90.0)],
        "`LOCATION#` string, WAVID string, `TERRITORY MANAGER` string, `SALES MANAGER` string, "
        "Q7 string, Q8 string, Q9 string, Q10 string, Q11 string, Q12 string, Q14 string, Q18 string, "
        "SESCORE double")


def test_layouts_normalised_and_unioned(spark):
    out = {r["site_id"]: r for r in normalise_files([_legacy(spark), _current(spark)]).collect()}
    assert out["101"]["wave_id"] == "20171"
    assert out["101"]["q14"] == "Caution" and out["101"]["q18"] == "No"   # Q15 -> Q14, Q19 -> Q18
    assert out["102"]["q8"] is None and out["102"]["experience_score"] == 90.0


def test_unknown_layout_is_not_appended(spark):
    bad = spark.createDataFrame([("1", "20191")], "`LOCATION#` string, WAVID string")
    with pytest.raises(ValueError):
        normalise_files([_current(spark), bad])
    good, rejected = normalise_files([_current(spark), bad], quarantine=True)
    assert good.count() == 1 and len(rejected) == 1


def test_numeric_ids_never_print_as_doubles(spark):
    df = spark.createDataFrame([(101.0, 20172.0, "T", "S") + ("Yes",) * 8 + (1.0,)],
                               "`LOCATION#` double, WAVID double, `TERRITORY MANAGER` string, "
                               "`SALES MANAGER` string, Q7 string, Q8 string, Q9 string, Q10 string, "
                               "Q11 string, Q12 string, Q14 string, Q18 string, SESCORE double")
    r = normalise_files([df]).first()
    assert (r["site_id"], r["wave_id"]) == ("101", "20172")


def test_file_fitting_both_layouts_uses_wave_year(spark):
    cols = ("`LOCATION#` string, WAVID string, `TERRITORY MANAGER` string, `SALES MANAGER` string, "
            "Q7 string, Q8 string, Q9 string, Q10 string, Q11 string, Q12 string, "
            "Q14 string, Q15 string, Q18 string, Q19 string, SESCORE double")
    row = ("1", "20172", "T", "S", "Yes", "Yes", "Yes", "Yes", "Yes", "Yes", "No", "Caution", "No", "Yes", 5.0)
    r = normalise_files([spark.createDataFrame([row], cols)]).first()
    assert (r["q14"], r["q18"]) == ("Caution", "Yes")        # 2017 -> legacy layout: Q15, Q19
    row18 = row[:1] + ("20182",) + row[2:]
    r = normalise_files([spark.createDataFrame([row18], cols)]).first()
    assert (r["q14"], r["q18"]) == ("No", "No")              # 2018 -> current layout: Q14, Q18
