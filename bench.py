"""Headline queries on the driver tables: one JSON line with seconds per query.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores.  Every query is run whole
(all columns of all rows are computed) into a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from silverlode.session import local_session
from workbook import load_all

QUERIES = [
    "m1_customer_cohort", "m2_customer_order_summary", "m3_customer_restaurant_preferences", "m5_delivery_agent_performance",
    "m6_delivery_location_performance", "m8_delivery_time_analysis", "m9_order_cohort", "m10_customer_journey",
    "m11_order_fulfillment", "m12_order_payment", "m13_restaurant_daily", "m14_order_status_analysis", "m15_order_summary",
    "m16_order_time_analysis", "m17_cuisine_performance", "m18_menu_performance", "m19_restaurant_performance",
    "d1_executive_kpis", "d28_top_cities", "q7_validate", "q10_statistics", "u1_merge", "u6_scd2_full", "u8_transitions",
    "r1_sla_dashboard", "r2_degradation", "t2_business_metrics", "t12_completeness", "x2_top_restaurants_by_items",
    "r12_files_to_gold", "r12_stream_to_gold",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    cases = load_all()
    cases["m1_customer_cohort"].run(spark, folder).count()  # starts the JVM's code paths
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or QUERIES:
        started = time.perf_counter()
        cases[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
