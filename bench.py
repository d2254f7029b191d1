"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated, default below).
Each query runs once to warm up and once timed; its whole result is materialised without collecting it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import local_session  # noqa: E402
from suite import QUERIES  # noqa: E402

HEADLINE = [
    "monthly_money_flow",
    "daily_metrics",
    "merge_upsert",
    "versioned_dimension",
    "point_in_time_join",
    "dedupe_first",
    "median_imputation",
    "bank_performance_fact",
    "quality_checks",
    "peer_comparison",
    "describe_lineitem",
    "correlation_matrix",
    "box_plot_stats",
    "histogram_by_key",
    "tick_moving_average",
    "rolling_correlation",
    "sliding_windows",
    "ordered_time_split",
    "warped_distance",
    "autoregressive_baseline",
    "price_forecast",
    "pca_variance",
    "entity_clusters",
    "silhouette_of_labels",
    "auc_of_large_table",
    "risk_predictions",
    "panel_fixed_effects",
    "granger_causality",
]


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("bench")
    took = {}
    for name in names:
        run(spark, name, sf)
        took[name] = round(run(spark, name, sf), 3)
        spark.catalog.clearCache()
    digits = os.path.basename(sf.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": float(digits) if digits.replace(".", "", 1).isdigit() else digits,
            }
        )
    )


if __name__ == "__main__":
    main()
