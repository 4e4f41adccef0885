"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Arguments select queries by name.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandspark.plans.queries import QUERIES  # noqa: E402
from demandspark.session import build_session  # noqa: E402

HEADLINE = ("rollups", "dedupe_latest", "dedupe_first", "clean_silver", "daily_category", "forecast_mart", "dq_suite",
            "upsert_newer", "upsert_metrics", "snapshot_diff", "lake_build", "parity_summary", "parity_rows",
            "parity_layers", "replay_slice", "lag_features", "seasonal_naive", "score", "trend_season", "rolling_cv",
            "direct_tree", "forecast_vs_actual", "yoy_ranking", "kpis", "stream_ingest", "stream_rollups")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    spark = build_session("bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g",
                          spark__sql__shuffle__partitions=cpus, spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the JVM before the first timing
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
