"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores. Every query runs once to warm
up and then BENCH_RUNS times for the median; its result goes to the no-op sink, so all rows and
columns are computed. The payment tables derived from the driver's tables are written once, during
the first warm-up that needs them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from saldo.session import recommended
from workload.queries import QUERIES

HEADLINE = [
    "a01_payment_intervals", "a02_payment_summary", "a03_provider_comparison", "a04_risk_overview",
    "a05_payment_trends", "a06_customer_segments", "a13_retry_label",
    "m02_customer_metrics", "m03_merchant_metrics", "m04_daily_summary", "m08_fct_payments",
    "m10_scd2_merge", "m11_interval_rebuild",
    "v01_split_charges", "v09_run_split_streams", "v11_dedupe", "v13_stream_interval_metrics",
    "n26_normalize", "n29_check_structure", "n30_audit_signatures",
    "e09_recovery_plan", "e13_enrich", "e14_to_bronze",
    "s06_ingest_events", "s15_upsert", "s16_upsert_enrichment",
    "x01_feat_customer", "x06_point_in_time_join", "x07_feat_customer_windowed",
    "q07_quarantine_summary", "l03_synthetic_labels",
]
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = [n for n in HEADLINE if not sys.argv[1:] or n.split("_")[0] in sys.argv[1:]]
    spark = (
        recommended(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
