"""Time the headline queries and print one JSON line.

Every query is run twice: "cold" holds the first run (with code generation),
"queries" the second. Every query is run to the end through a sink that drops the rows, so the time
covers the whole result and nothing is gathered on the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from obsledger import queries as Q
from obsledger.session import get_session

HEADLINE = [
    "risk_flow", "null_profile", "describe_num", "corr_matrix", "histogram", "impute_median", "impute_mode",
    "outlier_flag", "calendar_parts", "one_hot", "next_day_label", "lead_targets", "supplier_leads", "diff_stats",
    "positional_split_events", "first_n_per_entity", "entity_rank", "mean_by_entity", "composite_risk",
    "group_contrast", "regression_metrics", "class_report", "canonical_metrics", "performance_summary",
    "standardize", "nb_fit", "nb_predict", "ols_metrics", "kmeans_assign", "linear_svr", "coherent_sequences",
    "latest_location_view",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    Q.load_all()
    names = sys.argv[1:] or HEADLINE
    took, cold = {}, {}
    for name in names:
        for times in (cold, took):
            start = time.perf_counter()
            Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "cold": cold, "cold_total": round(sum(cold.values()), 3),
                      "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
