"""Times the headline queries; prints one JSON line.

Every query starts from the raw tables: phase tables kept by earlier queries are
forgotten before each one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayline.plans import catalog  # noqa: E402
from stayline.plans.catalog.base import forget_tables  # noqa: E402
from stayline.session import local_session  # noqa: E402

HEADLINE = [
    "rfm_metrics", "order_value_stats", "category_hhi", "interpurchase_time", "trend_features",
    "purchase_behavior", "customer_features", "rfm_scoring", "segment_profile", "payment_summary",
    "discount_estimate", "ingest_transactions", "ingest_customers", "customer_profitability",
    "profit_pipeline", "pareto_cumulative", "churn_labels", "stratified_split", "retention_pipeline",
    "decision_matrix", "sensitivity_analysis", "auc_roc", "export_transactions_summary",
    "export_category_performance", "export_segment_summary", "kpi_overview", "monthly_mom",
    "correlation_matrix", "histogram", "kmeans_segments", "churn_pipeline",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.queries()
    queries["monthly_orders"](spark, folder).count()  # starts the JVM's readers
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        forget_tables()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
