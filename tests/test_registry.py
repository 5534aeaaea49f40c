"""A cross-section of the registered queries against their check SQL, at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from check import compare, duck
from workbook import load_all

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "m1_customer_cohort", "m2_customer_order_summary", "m6_delivery_location_performance", "m9_order_cohort", "m10_customer_journey",
    "m12_order_payment", "m13_restaurant_daily", "m16_order_time_analysis", "m17_cuisine_performance", "m18_menu_performance",
    "d1_executive_kpis", "a12_cohort_matrix", "x2_top_restaurants_by_items", "q7_validate", "q10_statistics", "u6_scd2_full",
    "u10_dim_date", "p5_event_view", "j5_wildcard_join", "r1_sla_dashboard", "r7_settled_queue", "t4_latency", "s1_csv_scan",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_check(spark, con, name):
    _, text, good = compare(load_all()[name], spark, FOLDER, con)
    assert good, text


def test_driver_contract(spark):
    queries, checks = driver.queries(), driver.oracle_sql()
    assert set(checks) <= set(queries) and len(queries) > 180
    flagship = driver.entry(spark)
    assert flagship.limit(1).count() == 1 and "city_daily_order_rank" in flagship.columns
