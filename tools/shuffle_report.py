"""Rows read from files and rows / bytes written to shuffles per headline
query, from Spark's event log (written to a scratch folder; no UI, no
server). Rows are used for input because the local file system reports no
byte counts.

usage: python tools/shuffle_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, ".")

HEADLINE = ("prices_dedupe_first", "pages_class_text", "survey_pivot", "period_open",
            "points_total", "region_rank", "owner_region_avg", "member_vs_other")


def main(argv):
    from sitegauge.registry import QUERIES
    from sitegauge.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="shuffle-report-")
    os.makedirs(f"{scratch}/events")
    spark = build_session(master="local[8]", shuffle_partitions=16, app="shuffle-report",
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": f"file://{scratch}/events",
                                 "spark.eventLog.compress": "false",
                                 "spark.checkpoint.dir": f"{scratch}/ckpt"})
    sc = spark.sparkContext
    for name in HEADLINE:
        sc.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group: dict[int, str] = {}
    read = defaultdict(int)
    shuffled = defaultdict(int)
    shuffled_bytes = defaultdict(int)
    paths = [p for p in glob.glob(f"{scratch}/events/**/*", recursive=True)
             if os.path.isfile(p) and os.path.basename(p).startswith(("events", "local-", "app-"))]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    g = stage_group.get(ev.get("Stage ID"))
                    read[g] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    w = m.get("Shuffle Write Metrics") or {}
                    shuffled[g] += w.get("Shuffle Records Written", 0)
                    shuffled_bytes[g] += w.get("Shuffle Bytes Written", 0)
    print("| Query | rows read from files | rows shuffled | shuffled / read | MB shuffled |")
    print("| --- | --- | --- | --- | --- |")
    for name in HEADLINE:
        r, s = read[name], shuffled[name]
        ratio = f"{s / r:.2f}" if r else "-"
        print(f"| `{name}` | {r:,} | {s:,} | {ratio} | {shuffled_bytes[name] / 1e6:.1f} |")


if __name__ == "__main__":
    main(sys.argv)
