"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from custlens.plans import catalog
from custlens.session import build_session

HEADLINE = [
    "rfm_last_order",
    "rfm_scores",
    "denormalise_orders",
    "fill_price_coalesce",
    "customer_aggregate",
    "campaign_kpis",
    "campaign_performance",
    "segment_performance",
    "temporal_trends",
    "product_preferences",
    "basket_stats",
    "segment_value",
    "segment_profile",
    "clv_margin",
    "clv_projected",
    "top_customers",
    "box_stats",
    "correlation_pearson",
    "correlation_spearman",
    "churn_dataset",
    "stratified_split",
    "davies_bouldin",
    "roc_auc",
    "segment_recommendations",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("rfm_last_order")  # start the executors and compile the common stages
    seconds = {name: run(name) for name in names}
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}
        )
    )


if __name__ == "__main__":
    main()
