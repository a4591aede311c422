"""Time the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is planned anew and run to a sink that discards rows, so the time covers the
whole plan and no transfer to the driver. The first run warms the JVM; the best of the
following ones counts. ``value`` is the sum over the headline queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanrisk.plans.registry import queries  # noqa: E402
from loanrisk.session import local_session  # noqa: E402

HEADLINE = (
    "risk_metrics_as_coded",
    "portfolio_risk_summary",
    "high_risk_accounts_top10",
    "credit_score_trends_top5",
    "risk_metrics",
    "risk_summary",
    "score_progression",
    "risk_history",
    "risk_point_in_time",
    "staging_quarantine",
    "append_scores",
)
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(
        cores, int(cores) if cores.isdigit() else 8, **{"spark.ui.showConsoleProgress": "false"}
    )
    timings = {}
    for name, query in queries().items():
        seconds(spark, query, sf_dir)
        timings[name] = round(min(seconds(spark, query, sf_dir) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "sum of headline query times",
        "value": round(sum(timings[name] for name in HEADLINE), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
