"""Time the score progression of one account whose observations all fall on one day.

The day is cut into about 10, 100, 1,000 and 10,000 chunks by scaling the row limit down, to see
that the cost of finding a row's chunk does not follow the number of cuts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from loanrisk.operators import history  # noqa: E402
from loanrisk.operators.hotkeys import HotKeyLimits  # noqa: E402
from loanrisk.session import local_session  # noqa: E402

ROWS = int(os.environ.get("BENCH_ROWS", "300000"))
CUTS = (10, 100, 1_000, 10_000)


def main() -> None:
    cores = os.environ.get("BENCH_CPUS", "4")
    spark = local_session(cores, 8, **{"spark.ui.showConsoleProgress": "false"})
    scores = spark.range(ROWS).select(
        F.lit("A").alias("account_id"),
        F.format_string("S%010d", F.pmod(F.xxhash64("id"), F.lit(10**10))).alias("score_id"),
        F.to_date(F.lit("2024-01-01")).alias("score_date"),
        (F.col("id") % 600 + 300).cast("int").alias("credit_score"),
    )
    seconds = {}
    for cuts in (CUTS[0], *CUTS):  # the first one warms up
        limits = HotKeyLimits(rows=max(1, ROWS // cuts), draw_one_in=1)
        start = time.perf_counter()
        history.score_progression(scores, limits=limits).write.format("noop").mode("overwrite").save()
        seconds[str(cuts)] = round(time.perf_counter() - start, 2)
    print(json.dumps({"metric": "score progression of one account-day by cuts", "rows": ROWS,
                      "unit": "sec", "queries": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
