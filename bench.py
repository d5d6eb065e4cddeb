"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables folder and ``BENCH_CPUS`` the local cores. Every query is
built and drained into a sink that discards rows. What the queries build on (staged tables,
earlier dimension and fact states) is derived and stored first and timed as ``stored_layers``.
"""

from __future__ import annotations

import json
import os
import time

from stayflow.session import build_session
from stayflow.workload.layers import layers_for
from stayflow.workload.queries import REGISTRY

HEADLINE = [
    "stg_bookings",
    "stg_customers",
    "stg_reviews",
    "dedup_latest",
    "lookup_current_sk",
    "dim_hotels_scd1",
    "dim_customers_scd2",
    "dim_staff_scd2",
    "dim_room_rates_scd2",
    "surrogate_keys",
    "fact_bookings_merge",
    "fact_reviews_merge",
    "mart_revenue",
    "mart_occupancy",
    "mart_customer_segments",
    "mart_satisfaction",
    "mart_staff",
    "mart_hotel_performance",
    "kpi_cards",
    "hotel_ranking",
    "ingest_incremental",
    "pipeline_two_batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "stayflow-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    timed("stored_layers", layers_for(spark, sf_dir).store_all)
    for name in HEADLINE:
        query = REGISTRY[name].query
        timed(name, lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
