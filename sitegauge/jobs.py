"""The two jobs end to end, as a user runs them (entry points A and C).

    python -m sitegauge.jobs prices --pages PAGES.parquet --run-date 2018-08-26 --out OUT
    python -m sitegauge.jobs scorecard --sf-dir /root/testdata/sf0.01 --world customer --out OUT
    python -m sitegauge.jobs price-stream --source DROPS/ --out OUT --checkpoint CKPT [--continuous]

Both take the run date as a parameter (never the clock) and write
idempotently: re-running a day replaces that day's output only.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.operators.dedupe import keep_first
from sitegauge.operators.quality import observe_rows, zero_rows
from sitegauge.plans.prices import scrape_prices
from sitegauge.plans.reports import write_report_stores, write_scored
from sitegauge.plans.scorecard import build_scorecard
from sitegauge.sources.price_log import append_log, read_price_log_csv, write_final_csv
from sitegauge.sources.schemas import PAGES, VENDORS


def run_price_history(spark: SparkSession, pages: DataFrame, run_date: dt.date,
                      out: str, legacy_log: str | None = None) -> dict:
    """Scrape today's pages, append to the log (one ``snapshot_date``
    partition per run date, replaced on a re-run), keep the first row per
    (product, day) over the whole log and rewrite the final list (Z1, A9, Z2).
    ``legacy_log`` is a price log in the old CSV form; its rows count as
    history older than any dated run, in file order (migration).
    Returns row counts in and out (S13)."""
    out = out.rstrip("/")
    today = scrape_prices(pages, run_date).select(
        "product", *VENDORS, "date",
        F.col("page_id").alias("ingest_page"), F.col("pos").alias("ingest_pos"),
        F.lit(run_date.isoformat()).alias("snapshot_date"))
    today, seen = observe_rows(today, "scraped")
    append_log(today, f"{out}/log")
    # Declared schema: a run that scraped nothing still reads (and keeps) the
    # history, and the partition column stays ISO text.
    log = spark.read.schema(today.schema).parquet(f"{out}/log")
    if legacy_log is not None:
        old = read_price_log_csv(spark, legacy_log).select(
            "product", *VENDORS, "date", F.lit(0).cast("long").alias("ingest_page"),
            F.col("ingest_seq").cast("long").alias("ingest_pos"),
            F.lit("").alias("snapshot_date"))
        log = old.unionByName(log)
    final = keep_first(log, ["product", "date"], ["snapshot_date", "ingest_page", "ingest_pos"],
                       keep=["product", *VENDORS, "date"])
    final, kept = observe_rows(final.select("product", *VENDORS, "date"), "final")
    write_final_csv(final, f"{out}/final")
    return {"scraped_today": seen.get["rows"], "final_rows": kept.get["rows"]}


def run_scorecard(world, out: str, snapshots: str | None = None) -> dict:
    """Build the scorecard of one world, write the scored table under its run
    date (Z3) and the three report stores (Z4). Returns the slot plan
    and a data-quality count (sites with a zero service score, F4). With
    ``snapshots`` the day's pulls are reused by a re-run (S12)."""
    card = build_scorecard(world, snapshot_root=snapshots)
    scored = write_scored(card, out, world.run_date)
    reports = write_report_stores(card, world.assignment, out, world.run_date)
    zero = zero_rows(card.survey, "service_num").count()
    return {"scored": scored, "reports": reports,
            "window": None if card.plan.window is None else
            [card.plan.window.max_year, card.plan.window.max_month],
            "slots": [[p.year, p.trimester, p.is_ptd, p.score_ok] for p in card.plan.pairs],
            "latest_by_source": {k: list(v) for k, v in card.plan.latest.items()},
            "facts_disagree": card.plan.facts_disagree,
            "current_slot": None if card.plan.current is None else
            [card.plan.current.year, card.plan.current.trimester, card.plan.current.is_ptd],
            "zero_service_scores": zero}


def _world_from_folder(spark: SparkSession, folder: str, run_date: dt.date):
    import glob
    import os

    from sitegauge.sources.inputs import world_from_files

    def one(role):
        found = sorted(glob.glob(os.path.join(folder, f"{role}.*")))
        if not found:
            raise FileNotFoundError(f"no {role}.csv or {role}.parquet in {folder}")
        return found[0]

    surveys = sorted(glob.glob(os.path.join(folder, "survey*")))
    return world_from_files(spark, run_date, one("roster"), one("hierarchy"), surveys,
                            one("volume"), one("loyalty"), one("assignment"))


def main(argv: list[str] | None = None) -> None:
    from sitegauge.session import build_session
    from sitegauge.sources.standins import customer_world, supplier_world

    ap = argparse.ArgumentParser(prog="sitegauge.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    pr = sub.add_parser("prices")
    pr.add_argument("--pages", required=True)
    pr.add_argument("--run-date", required=True, type=dt.date.fromisoformat)
    pr.add_argument("--out", required=True)
    pr.add_argument("--legacy-log", help="an existing price log CSV to continue from")
    st = sub.add_parser("price-stream")
    st.add_argument("--source", required=True, help="folder the scraper drops Parquet files into")
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", required=True, help="streaming checkpoint (shared storage)")
    st.add_argument("--format", choices=["parquet", "csv"], default="parquet",
                    help="file format of the scrape drops")
    st.add_argument("--continuous", action="store_true",
                    help="keep running (one micro-batch a minute) instead of draining once")
    st.add_argument("--max-files", type=int, help="files per micro-batch at most")
    sc = sub.add_parser("scorecard")
    sc.add_argument("--sf-dir", help="run on the stand-in tables of this folder")
    sc.add_argument("--world", choices=["customer", "supplier"], default="customer")
    sc.add_argument("--run-date", type=dt.date.fromisoformat,
                    help="with --inputs: the run date")
    sc.add_argument("--inputs", help="folder with roster, hierarchy, volume, loyalty, "
                    "assignment (.csv or .parquet) and survey*.csv files")
    sc.add_argument("--out", required=True)
    sc.add_argument("--snapshots", help="folder of dated pulls reused by same-day re-runs")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(master=args.master, shuffle_partitions=None)
    if args.job == "price-stream":
        from sitegauge.streaming.price_history import start
        out = args.out.rstrip("/")
        query = start(spark, args.source, f"{out}/log", f"{out}/final", args.checkpoint,
                      available_now=not args.continuous, max_files_per_trigger=args.max_files,
                      source_format=args.format)
        query.awaitTermination()
        result = {"log": f"{out}/log", "final": f"{out}/final"}
    elif args.job == "prices":
        pages = spark.read.schema(PAGES).parquet(args.pages)
        result = run_price_history(spark, pages, args.run_date, args.out, args.legacy_log)
    elif args.inputs:
        result = run_scorecard(_world_from_folder(spark, args.inputs, args.run_date), args.out,
                               args.snapshots)
    else:
        build = customer_world if args.world == "customer" else supplier_world
        result = run_scorecard(build(spark, args.sf_dir), args.out, args.snapshots)
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
