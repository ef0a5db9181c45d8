"""Time the headline queries; print one JSON line.

BENCH_SF_DIR is the folder of Parquet tables, BENCH_CPUS the number of local cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.registry import QUERIES  # noqa: E402
from salesmart.session import build_session  # noqa: E402

HEADLINE = (
    "stg_customers", "stg_products", "stg_orders", "dim_customers", "dim_products", "dim_dates",
    "fact_orders", "revenue_analysis", "quarterly_revenue", "customer_value", "margin_by_tier",
    "star_sample_full", "recent_orders", "check_suite", "row_counts", "upsert", "synth_orders",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        # Every row and column of the result is made, and none is kept.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("revenue_analysis")  # start-up of the JVM's compilers is not a query's time
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rpartition("sf")[2],
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
