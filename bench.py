"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS``
(default 1) timed runs after ``BENCH_WARMUPS`` (default 0) untimed ones. The value is the sum
of the medians; planning and code generation count.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from caselake.session import build_session
from caselake.workload import queries

HEADLINE = (
    "q_monthly_by_nation", "q_report_top_nations", "q_enrich_roles", "q_dedup_rank",
    "q_latest_version", "q_quality_codes", "q_set_compare", "q_orphans", "q_dim_date",
    "q_star_enriched", "q_case_codes", "q_gold_monthly_uf", "q_acceptance",
    "q_event_contract", "q_minute_counters", "q_history_page", "q_stream_counters",
)


def timed(spark, run, folder: str) -> float:
    started = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs, warmups = int(os.environ.get("BENCH_RUNS", "1")), int(os.environ.get("BENCH_WARMUPS", "0"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    bound = queries()
    seconds = {}
    for name in HEADLINE:
        for _ in range(warmups):
            timed(spark, bound[name], folder)
        seconds[name] = round(statistics.median(timed(spark, bound[name], folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": f"sum of query medians after {warmups} warm-ups", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
