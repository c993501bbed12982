"""Committed snapshots and the quarantine of price-log rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sitegauge.plans import reports
from sitegauge.sources import quarantine
from sitegauge.sources.snapshot import (MANIFEST, read_or_build_snapshot, read_snapshot, snapshot_path, why_not, write_snapshot)

DAY = dt.date(2018, 8, 10)


def build(spark, n=10, calls=None, more=False):
    def run():
        if calls is not None:
            calls.append(1)
        out = spark.range(n).withColumn("v", F.col("id") * 2)
        return out.withColumn("w", F.lit("x")) if more else out
    return run


def test_a_snapshot_counts_when_its_manifest_is_there(spark, scratch):
    path = snapshot_path(scratch, "pull", DAY)
    assert why_not(spark, path) == "no manifest"
    with pytest.raises(ValueError, match="no manifest"):
        read_snapshot(spark, path)
    # a run that died while writing: data without a manifest
    build(spark, 3)().write.parquet(f"{path}/data-half")
    got = read_or_build_snapshot(spark, scratch, "pull", DAY, build(spark))
    assert got.count() == 10 and why_not(spark, path) is None
    files = sorted(os.listdir(path))
    calls = []
    assert read_or_build_snapshot(spark, scratch, "pull", DAY, build(spark, 99, calls)).count() == 10
    assert calls == []          # the day's pull is reused, its sources aren't touched
    assert sorted(os.listdir(path)) == files


def test_half_written_changed_and_other_snapshots_are_refused(spark, scratch):
    path = snapshot_path(scratch, "pull", DAY)
    manifest = write_snapshot(build(spark)().repartition(3), path, inputs="files of today")
    assert manifest.rows == 10
    assert why_not(spark, path, inputs="files of tomorrow") == "other inputs"
    assert why_not(spark, path, build(spark, more=True)().schema) == "another schema"
    assert why_not(spark, path, build(spark)().schema, "files of today") is None
    part = next(f for f in sorted(os.listdir(f"{path}/{manifest.data}")) if f.endswith(".parquet"))
    os.remove(f"{path}/{manifest.data}/{part}")
    assert "rows instead of 10" in why_not(spark, path)
    again = read_or_build_snapshot(spark, scratch, "pull", DAY, build(spark), inputs="files of today")
    assert again.count() == 10
    # a changed schema is built anew, and the last manifest counts
    wide = read_or_build_snapshot(spark, scratch, "pull", DAY, build(spark, 4, more=True), schema=build(spark, more=True)().schema)
    assert wide.columns == ["id", "v", "w"] and wide.count() == 4
    write_snapshot(build(spark, 6)(), path)
    assert read_snapshot(spark, path).count() == 6 and os.path.exists(f"{path}/{MANIFEST}")
    assert not [f for f in os.listdir(path) if f.startswith(".manifest") and not f.endswith(".crc")]


def test_report_store_has_bounded_files_and_one_is_read(spark, scratch):
    n = F.col("id")
    rows = spark.range(0, 3000, 1, 4).select(
        F.when(n < 1000, F.lit("North")).otherwise(F.concat(F.lit("R"), (n % 3).cast("string"))).alias("region"),
        F.when(n < 1000, F.lit("Big, O'Neil")).otherwise(F.concat(F.lit("own"), (n % 700).cast("string"))).alias("owner_name"), n.alias("site_id"))
    path = f"{scratch}/raw"
    reports.write_report_store(rows, path, rows_per_file=100)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert 30 <= len(files) <= 40                          # by rows, not by owners (2,101 of them)
    assert spark.read.parquet(path).count() == 3000
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
    assert len(reports.report_files(spark, path, "R1", "own1")) == 1
    got = reports.read_report(spark, path, " r1 ", "own1")
    assert len(got.inputFiles()) == 1
    assert sorted(r["site_id"] for r in got.collect()) == sorted(
        r["site_id"] for r in rows.where("region = 'R1' and owner_name = 'own1'").collect())
    big = reports.read_report(spark, path, "North", "Big, O'Neil")
    assert big.count() == 1000 and 10 <= len(big.inputFiles()) <= 15
    assert reports.read_report(spark, path, "North", "nobody").count() == 0


LOG = '''product,apple,amazon,adorama,macmall,bestbuy,b_and_h,date
"Laptop, 13in",1450.00,N/A,,"$1,460.00",1399.99,1388.00,08/26/2018
too,few,fields
Desk,1,2,3,4,5,6,08/26/2018,too many
,1,2,3,4,5,6,08/26/2018
Desk,1,2,3,4,5,6,2018-08-26
Desk,cheap,-2,3,4,5,6,13/45/2018
Desk,1,2,3,4,5,6,08/27/2018
'''


def test_rows_with_faults_are_kept_apart_with_reasons(spark, scratch):
    path = os.path.join(scratch, "log.csv")
    with open(path, "w") as f:
        f.write(LOG)
    checks = quarantine.rules()
    rows, seen = quarantine.counted(quarantine.tagged(quarantine.read_log_lines(spark, path), checks), "log", list(checks))
    rows.write.parquet(f"{scratch}/tagged")
    assert seen.get["rows"] == 7 and seen.get["rejected"] == 5 and seen.get["broken record"] == 2
    good, rejected = quarantine.split(spark.read.parquet(f"{scratch}/tagged"))
    assert [(r["product"], r["macmall"], r["adorama"]) for r in good.orderBy("date").collect()] == [("Laptop, 13in", 1460.0, None), ("Desk", 4.0, 3.0)]
    assert {(tuple(r["reasons"]), r["raw_line"]) for r in rejected.collect()} == {
        (("broken record",), "too,few,fields"), (("broken record",), "Desk,1,2,3,4,5,6,08/26/2018,too many"),
        (("no product",), None), (("unreadable date",), None),
        (("unreadable date", "unreadable price: apple", "negative price: amazon"), None)}
