"""Summarise the final (AQE) physical plan of each headline query: shuffle,
broadcast and join counts, partial aggregation, windows, Python nodes, and
per-scan pushed filters / read schema. Prints Markdown.

usage: python tools/plan_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

COUNTED = [("shuffles", r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition"),
           ("broadcasts", r"BroadcastExchange"),
           ("sort-merge joins", r"SortMergeJoin"),
           ("broadcast hash joins", r"BroadcastHashJoin"),
           ("partial aggregates", r"(?:Hash|ObjectHash|Sort)Aggregate\(keys?=.*functions=\[partial_"),
           ("windows", r"\bWindow \["),
           ("python nodes", r"EvalPython|FlatMapGroupsInPandas|MapInPandas")]


def summarise(name, df):
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    counts = {k: len(re.findall(p, text)) for k, p in COUNTED}
    scans = []
    for line in text.splitlines():
        if "FileScan parquet" in line or "Scan parquet" in line:
            table = re.search(r"/([\w.-]+)\.parquet|/(sitegauge-\w+)-", line)
            label = (table.group(1) or table.group(2)) if table else "?"
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            schema = re.search(r"ReadSchema: (struct<\S*)", line)
            scans.append((label, pushed.group(1) if pushed else "", schema.group(1) if schema else ""))
    print(f"### `{name}`\n")
    print("| " + " | ".join(counts) + " |")
    print("| " + " | ".join("---" for _ in counts) + " |")
    print("| " + " | ".join(str(v) for v in counts.values()) + " |\n")
    seen = set()
    for label, pushed, schema in scans:
        if (label, pushed, schema) in seen:
            continue
        seen.add((label, pushed, schema))
        print(f"* scan `{label}`: pushed `[{pushed[:200]}]`, read `{schema[:240]}`")
    print()


def main(argv):
    from sitegauge.registry import QUERIES
    from sitegauge.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or ["prices_dedupe_first", "pages_class_text", "survey_pivot", "period_open",
                         "points_total", "region_rank", "owner_region_avg", "member_vs_other"]
    spark = build_session(master="local[8]", shuffle_partitions=16,
                          extra={"spark.sql.maxMetadataStringLength": "1000"})
    for n in names:
        summarise(n, QUERIES[n](spark, sf_dir))


if __name__ == "__main__":
    main(sys.argv)
