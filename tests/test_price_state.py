"""Streaming keep-first in a state store against the batch query."""

import os
import random

from pyspark.sql import functions as F

from sitegauge.operators.dedupe import keep_first
from sitegauge.sources.schemas import VENDORS
from sitegauge.streaming import price_state
from sitegauge.streaming.price_history import SCRAPE_SCHEMA


def drop(spark, folder, name, rows):
    spark.createDataFrame(rows, SCRAPE_SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def row(product, day, seq, price):
    return (product, f"${price:,.2f}", "N/A", None, "nan", "", "12.5", day, seq)


def run(spark, src, out, ckpt, **more):
    for q in price_state.start(spark, f"{src}/*", out, ckpt, **more).values():
        q.awaitTermination()
        assert q.exception() is None
    return price_state.read_rows(spark, out, "log"), price_state.read_rows(spark, out, "final")


def same(a, b):
    cols = ["product", *VENDORS, "date", "ingest_seq", "day"]
    return sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def batch(log):
    return keep_first(log, ["product", "date"], ["ingest_seq", *VENDORS], keep=[*VENDORS, "ingest_seq", "day"])


def test_reordered_late_and_retried_batches_equal_the_batch(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, x) for x in ("src", "out", "ckpt"))
    os.makedirs(src)
    rnd = random.Random(4)
    seq = iter(range(1, 10_000))
    days = [f"08/{d:02d}/2018" for d in range(1, 9)]
    rows = [row(rnd.choice(["p1", "p2", "p3", None, "hot"]), day, next(seq), rnd.randint(1, 5000)) for day in days for _ in range(12)]
    rows += [row("p1", None, next(seq), 3), row("p1", "no date", next(seq), 4), row("p1", "no date", next(seq), 5)]
    # a day's rows reach over three drops, and come in any order within them
    drops = [rows[i::1][:24] for i in range(0, len(rows), 24)]
    for d in drops:
        rnd.shuffle(d)
    for i, d in enumerate(drops[:2]):
        drop(spark, src, f"drop{i}", d)
    log, final = run(spark, src, out, ckpt, max_files_per_trigger=1)
    assert same(price_state.current_list(log, final), batch(log))

    # the last batch of the final list is run again after a crash before its commit
    commits = os.path.join(ckpt, "final", "commits")
    last = max(int(x) for x in os.listdir(commits) if x.isdigit())
    os.remove(os.path.join(commits, str(last)))
    if os.path.exists(os.path.join(commits, f".{last}.crc")):
        os.remove(os.path.join(commits, f".{last}.crc"))
    for i, d in enumerate(drops[2:], 2):
        drop(spark, src, f"drop{i}", d)
    # late: before the kept row of a closed day, behind it, and a product that the day lacked
    drop(spark, src, "late", [row("hot", days[0], 0, 1), row("hot", days[0], next(seq), 2), row("new", days[0], next(seq), 7)])
    log, final = run(spark, src, out, ckpt)
    assert log.count() == len(rows) + 3
    assert final.groupBy("product", "date").count().where("count > 1").count() == 0
    closed = {r["day"] for r in final.select("day").distinct().collect()}
    assert "2018-08-01" in closed and None not in closed
    assert same(price_state.current_list(log, final), batch(log))
    late = price_state.late_rows(log, final).where(F.col("day") == "2018-08-01").collect()
    assert {(r["product"], r["ingest_seq"]) for r in late} >= {("hot", 0)} and "new" in {r["product"] for r in late}
    before = sorted(map(str, final.collect()))

    # a run without new drops changes nothing
    log, final = run(spark, src, out, ckpt)
    assert sorted(map(str, final.collect())) == before and log.count() == len(rows) + 3


def test_state_is_dropped_when_days_close(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, x) for x in ("src", "out", "ckpt"))
    os.makedirs(src)
    for d in range(1, 6):
        drop(spark, src, f"d{d}", [row(f"p{k}", f"08/{d:02d}/2018", 10 * d + k, k + 1) for k in range(5)])
        queries = price_state.start(spark, f"{src}/*", out, ckpt, delay="1 day")
        for q in queries.values():
            q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in queries["final"].recentProgress if p["stateOperators"]]
    assert held and held[-1] == 5                  # the open day
    final = price_state.read_rows(spark, out, "final")
    assert final.count() == 20 and final.select(F.max("day")).first()[0] == "2018-08-04"
    plan = price_state.closed_firsts(price_state.scrape_stream(spark, f"{src}/*"), "1 day")
    assert plan.isStreaming
