"""Headline queries, timed end to end after one untimed run of the first; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinweave.session import build_session, clear_scratch  # noqa: E402
from workload import queries as q  # noqa: E402

HEADLINE = (
    "match_output_person", "rules_person", "all_fuzzy_person", "exact_dup_documents", "match_groups_documents",
    "fuzzy_part_blocked", "topk_matches_part", "golden_person", "merge_upsert_orders", "change_feed_orders",
    "metrics_300s_events", "dq_report_person", "norm_person_contact",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    getattr(q, HEADLINE[0])(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        getattr(q, name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale[1]) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
