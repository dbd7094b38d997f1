"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ONLY    comma-separated query names, or ``all``
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "daily_sales",
    "customer_kpis_week",
    "kpi_totals",
    "discount_share",
    "bulk_buyers",
    "pick_detail",
    "window_lead_time",
    "ops_flags",
    "stockouts",
    "one_location_per_order",
    "ticket_sales",
    "branch_state_agg",
    "mark_duplicates",
    "resolve_conflicts",
    "bronze_to_silver",
    "silver_to_gold",
    "upsert_result",
    "forward_fill",
    "infer_types",
    "quality_flags",
]


def main() -> None:
    from tributary.plans import queries  # noqa: F401
    from tributary.plans.registry import QUERIES
    from tributary.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY")
    names = list(QUERIES) if only == "all" else only.split(",") if only else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times, first = {}, {}
    for name in names:
        # The first run pays for code generation and class loading; the second is the one reported.
        for seen in (first, times):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seen[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries, second run",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": first,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
