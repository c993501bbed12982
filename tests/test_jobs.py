import datetime as dt
import os

from sitegauge.jobs import run_price_history, run_scorecard
from sitegauge.sources.standins import supplier_world

from conftest import SF001


def page(products, apple, amazon):
    cells = "".join(f'<div class="product-name">{p}</div>' for p in products)
    cells += "".join(f'<div class="row cell zero"><a href="#">{a}</a></div>' for a in apple)
    cells += "".join(f'<div class="cell one wide"><a href="#">{a}</a></div>' for a in amazon)
    for n in ("two", "three", "four", "five"):
        cells += "".join(f'<div class="cell {n}"><a href="#">N/A</a></div>' for _ in products)
    return f"<html><body>{cells}<p><br>unclosed</body></html>"


def test_price_history_two_runs(spark, scratch):
    out = os.path.join(scratch, "prices")
    day1 = spark.createDataFrame(
        [(1, "u1", page(["Item A", "Item B", "Item A"], ["$1,299.00", "$999", "$5"], ["N/A", "$990.50", "$6"]))],
        "page_id long, url string, html string")
    r1 = run_price_history(spark, day1, dt.date(2018, 8, 26), out)
    assert r1 == {"scraped_today": 3, "final_rows": 2}
    day2 = spark.createDataFrame([(1, "u1", page(["Item A"], ["$1,199.00"], ["N/A"]))],
                                 "page_id long, url string, html string")
    run_price_history(spark, day2, dt.date(2018, 8, 27), out)
    r3 = run_price_history(spark, day2, dt.date(2018, 8, 27), out)        # re-run: no duplicates
    assert r3["final_rows"] == 3
    final = {(r["product"], r["date"]): r for r in spark.read.option("header", True).csv(f"{out}/final").collect()}
    assert final[("Item A", "08/26/2018")]["apple"] == "1299.0"             # first Mac A row of the page
    assert final[("Item A", "08/27/2018")]["apple"] == "1199.0"
    assert final[("Item B", "08/26/2018")]["amazon"] == "990.5"


def test_scorecard_job_on_tables(spark, scratch):
    res = run_scorecard(supplier_world(spark, SF001), os.path.join(scratch, "sc"))
    assert res["window"] == [2001, 11]
    assert [2001, 3, True, True] in res["slots"]
    raw = spark.read.parquet(res["reports"]["raw"])
    assert raw.count() > 0 and {"region", "owner_name", "rank"} <= set(raw.columns)
    assert spark.read.parquet(res["scored"]).count() > 0


def test_scorecard_from_exported_files(spark, scratch):
    """Source-named CSV exports (spaces, CRM suffixes, two survey layouts)."""
    folder = os.path.join(scratch, "inputs")
    os.makedirs(folder)
    files = {
        "roster.csv": 'OPCO,CO/DO,LOCATION NO\n"NORTH ",d1,101\nnorth,d1,102\n',
        "hierarchy.csv": "Location_Number__c,Sold_To_Name__c,Sold_To_Number__c,Street__c,City__c\n"
                         "101,Own1,1,a st,x\n102,Own1,1,b st,y\n",
        "volume.csv": "Location_Number,Date,volume,premium_volume\n"
                      "101,2017-06-15,100,200\n101,2018-06-15,102,207\n101,2018-02-01,50,0\n"
                      "101,2017-02-01,40,0\n102,2017-05-20,0,0\n102,2018-05-20,5,5\n",
        "loyalty.csv": "Location_Number,Date,Loyalty\n101,2018-06-20,10\n102,2018-05-21,0.5\n",
        "assignment.csv": "TERRITORY MANAGER,OPCO/Region\nTM1,NORTH\n",
        "survey_2017.csv": "LocationCode,WavId,Territory Manager,Sales Manager,Q7_Response,Q8_Response,"
                           "Q9_Response,Q10_Response,Q11_Response,Q12_Response,Q15_Response,Q19_Response,SEScore\n"
                           "101,20172,TM1,S,Yes,Yes,Yes,Yes,Yes,Yes,Yes,Yes,70\n",
        "survey_2018.csv": "LOCATION#,WAVID,TERRITORY MANAGER,SALES MANAGER,Q7,Q8,Q9,Q10,Q11,Q12,Q14,Q18,SESCORE\n"
                           "101,20182,TM1,S,Yes,Yes,Yes,Yes,Yes,Yes,Yes,Yes,80\n"
                           "102,20182,TM1,S,Yes,Yes,Yes,Yes,Yes,Yes,Yes,Yes,60\n",
    }
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    from sitegauge.jobs import _world_from_folder
    world = _world_from_folder(spark, folder, dt.date(2018, 8, 10))
    res = run_scorecard(world, os.path.join(scratch, "out"))
    assert res["window"] == [2018, 6]
    raw = {r["site_id"]: r for r in spark.read.parquet(res["reports"]["raw"]).collect()}
    assert raw["102"]["rank"] == 1 and raw["101"]["rank"] == 2
    assert raw["101"]["region"] == "North"
    # the same run through the command line, with same-day snapshots
    from sitegauge.jobs import main
    cli_out = os.path.join(scratch, "cli")
    main(["scorecard", "--inputs", folder, "--run-date", "2018-08-10", "--out", cli_out,
          "--snapshots", os.path.join(scratch, "snaps")])
    cli = {r["site_id"]: r["rank"] for r in spark.read.parquet(f"{cli_out}/raw").collect()}
    assert cli == {"101": 2, "102": 1}


def test_price_history_empty_scrape(spark, scratch):
    out = os.path.join(scratch, "prices")
    pages = spark.read.parquet(f"{SF001}/pages.parquet")      # no price cells on these pages
    assert run_price_history(spark, pages, dt.date(2018, 8, 26), out) == {
        "scraped_today": 0, "final_rows": 0}


def test_numeric_roster_ids_from_parquet(spark, scratch):
    from sitegauge.sources.inputs import read_role
    path = os.path.join(scratch, "roster.parquet")
    spark.createDataFrame([("North", "d1", 101.0)], "OPCO string, `CO/DO` string, `LOCATION NO` double") \
        .write.parquet(path)
    assert [r["site_id"] for r in read_role(spark, "roster", path).collect()] == ["101"]


def test_export_missing_column_is_reported(spark, scratch):
    import pytest
    from sitegauge.sources.inputs import read_role
    path = os.path.join(scratch, "hierarchy.csv")
    with open(path, "w") as f:
        f.write("Location_Number__c,Sold_To_Name__c\n101,Own1\n")
    with pytest.raises(ValueError, match="owner_number"):
        read_role(spark, "hierarchy", path)


def test_price_history_continues_a_legacy_csv_log(spark, scratch):
    legacy = os.path.join(scratch, "old_log.csv")
    with open(legacy, "w") as f:
        f.write("product,apple,amazon,adorama,macmall,bestbuy,b_and_h,date\n"
                "Item A,1000.00,N/A,N/A,N/A,N/A,N/A,08/26/2018\n"
                "Item Z,5.00,N/A,N/A,N/A,N/A,N/A,08/25/2018\n")
    pages = spark.createDataFrame([(1, "u1", page(["Item A"], ["$1,299.00"], ["N/A"]))],
                                  "page_id long, url string, html string")
    out = os.path.join(scratch, "prices")
    res = run_price_history(spark, pages, dt.date(2018, 8, 26), out, legacy_log=legacy)
    assert res["final_rows"] == 2
    final = {(r["product"], r["date"]): r["apple"]
             for r in spark.read.option("header", True).csv(f"{out}/final").collect()}
    assert final == {("Item A", "08/26/2018"): "1000.0", ("Item Z", "08/25/2018"): "5.0"}
