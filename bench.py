"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the number of local threads. Each query is
run once to warm up and then timed; every result is written to a sink that keeps all columns.
"""

from __future__ import annotations

import json
import os
import time

from tablegrade.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "freshness",
    "asof_version",
    "schema_drift",
    "steward_signals",
    "check_coverage",
    "sync_checks",
    "reconciled_tags",
    "checks_upsert",
    "config_upsert",
    "summary_partial_upsert",
    "dimension_scores",
    "render_checks",
    "similar_topk",
    "retrieval_context",
    "low_cardinality",
    "column_counts",
    "check_results",
    "suggest_checks",
    "scoreboard",
    "scoreboard_after_enrichment",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder),
            }
        )
    )


if __name__ == "__main__":
    main()
