"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed end to end into Spark's ``noop`` sink (the whole plan
runs, nothing is collected to the driver). One untimed warm-up query loads
the JVM and the parquet footers; each query is then run ``$BENCH_REPEAT``
times (default 2) and its best time is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "prices_dedupe_first",
    "pages_class_text",
    "survey_pivot",
    "period_open",
    "points_total",
    "region_rank",
    "owner_region_avg",
    "member_vs_other",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from sitegauge.registry import QUERIES
    from sitegauge.session import build_session

    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=2 * cpus, app="bench",
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": f"{scratch}/ckpt",
                                 "spark.local.dir": f"{scratch}/local"})
    QUERIES["title_case_names"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf_text = os.path.basename(sf_dir).replace("sf", "")
    try:
        sf: float | str = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
