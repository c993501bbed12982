import os

from pyspark.sql import functions as F

from sitegauge.streaming.price_history import SCRAPE_SCHEMA, start

ROW = ("p1", "$1,299.00", "N/A", "N/A", "N/A", "N/A", "N/A", "08/26/2018")


def drop(spark, folder, name, rows):
    spark.createDataFrame(rows, SCRAPE_SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def test_incremental_keep_first(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    log, final, ckpt = (os.path.join(scratch, x) for x in ("log", "final", "ckpt"))
    drop(spark, src, "run1", [ROW + (1,), ("p1", "$1,100.00") + ROW[2:] + (2,),
                              ("p2", "$5") + ROW[2:] + (3,)])
    start(spark, f"{src}/*", log, final, ckpt).awaitTermination()
    drop(spark, src, "run2", [("p1", "$9") + ROW[2:] + (4,), ("p1", "$7", *ROW[2:7], "08/27/2018", 5)])
    start(spark, f"{src}/*", log, final, ckpt).awaitTermination()
    got = {(r["product"], r["date"]): r["apple"] for r in spark.read.parquet(final).collect()}
    assert got == {("p1", "08/26/2018"): 1299.0, ("p2", "08/26/2018"): 5.0, ("p1", "08/27/2018"): 7.0}
    assert spark.read.parquet(log).count() == 5
    # a third run without new files changes nothing
    start(spark, f"{src}/*", log, final, ckpt).awaitTermination()
    assert spark.read.parquet(final).count() == 3
    assert spark.read.parquet(final).where(F.col("day") == "2018-08-27").count() == 1


def test_stream_command_line(spark, scratch):
    from sitegauge.jobs import main
    src = os.path.join(scratch, "drops")
    os.makedirs(src)
    drop(spark, src, "run1", [ROW + (1,)])
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    main(["price-stream", "--source", f"{src}/*", "--out", out, "--checkpoint", ckpt])
    assert spark.read.parquet(f"{out}/final").count() == 1


def test_csv_drops(spark, scratch):
    src = os.path.join(scratch, "csv")
    os.makedirs(src)
    with open(os.path.join(src, "scrape1.csv"), "w") as f:
        f.write('product,apple,amazon,adorama,macmall,bestbuy,b_and_h,date,ingest_seq\n'
                '"Item, 13in","$1,299.00",N/A,N/A,N/A,N/A,N/A,08/26/2018,1\n'
                '"Item, 13in","$1,100.00",N/A,N/A,N/A,N/A,N/A,08/26/2018,2\n')
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    start(spark, src, f"{out}/log", f"{out}/final", ckpt, source_format="csv").awaitTermination()
    rows = spark.read.parquet(f"{out}/final").collect()
    assert [(r["product"], r["apple"]) for r in rows] == [("Item, 13in", 1299.0)]
