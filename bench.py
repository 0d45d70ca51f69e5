"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR  table folder, default /root/testdata/sf0.1
    BENCH_CPUS    local cores, default all
    BENCH_ALL     1 to time every query
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farelight.session import build_session
from registry.queries import QUERIES

HEADLINE = (
    "weekly_borough_kpis",
    "clean_trips",
    "filter_audit",
    "quality_report",
    "enrich_zones",
    "recent_weeks",
    "peak_hour",
    "night_share",
    "stage_counts",
    "missing_weeks",
    "kpi_roundtrip",
    "mart_summary",
    "mart_revenue_share",
    "mart_heatmap",
    "mart_describe",
    "status_events",
    "word_count",
    "word_count_lines",
    "char_counts",
    "text_stats",
    "retail_avg_by_month",
    "retail_dirty_split",
    "median_by_group",
    "sorted_by_amount",
    "avg_by_key",
    "avg_score_for_ids",
)


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = build_session(
        "farelight-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "8" if cpus == "*" else cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="farelight-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    # A first round over all queries warms up; the better of the next two counts.
    rounds = [{n: seconds(spark, n, sf_dir) for n in names} for _ in range(3)]
    times = {n: min(r[n] for r in rounds[1:]) for n in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {n: round(t, 3) for n, t in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
