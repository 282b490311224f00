"""Times the headline queries: `python bench.py` prints one JSON line.

Every query runs once to compile its stages and once on the clock, from the files each time.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the local cores, BENCH_QUERIES a subset.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from checks.registry import QUERIES
from platterflow.session import Run, local_session

HEADLINE = (
    "clean_lines", "dedupe_orders_delivery", "dedupe_orders_booking", "daily_panel", "daily_features",
    "recursive_forecast", "route_forecast", "station_month_kpis", "monthly_station_forecast",
    "monthly_item_ranking", "weekly_allocation", "item_month_panel", "item_forecast_ranking",
    "cancellation_features", "balanced_sample", "auc_ap", "station_month_top_items", "monthly_kpis",
    "global_items", "monthly_best_seller",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session("bench", tempfile.mkdtemp(prefix="bench-"), cores, partitions=int(cores) if cores.isdigit() else 8)
    seconds: dict[str, float] = {}
    for measured in (False, True):
        for name in names:
            start = time.perf_counter()
            with Run(spark):
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if measured:
                seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
