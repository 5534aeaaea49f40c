"""Physical plans: no cross products, no Python in the data path, pruned and filtered scans."""

import re
from pathlib import Path

import pytest

from silverlode.plans import order_marts, reports
from silverlode.sources.driver_tables import Entities
from workbook import load_all

FOLDER = "/root/testdata/sf0.001"
# Queries that hold the library's joins and windows between them.
CHECKED = ("m", "j", "w", "q7", "q12_stat", "d1_", "d28", "r1_", "r3_", "r7", "t5", "t12", "u1", "u2", "u4")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_products_and_no_python(spark):
    bad = {}
    for name, case in load_all().items():
        if not name.startswith(CHECKED):
            continue
        found = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|\w*Python\w*|MapInPandas|SinglePartition(?=.*Window)", plan_of(case.run(spark, FOLDER)))
        if found:
            bad[name] = sorted(set(found))
    assert bad == {}


def test_report_filter_and_columns_reach_the_scan(spark):
    t = Entities(spark, FOLDER)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    rows = reports.between(order_marts.order_summary(t, ("delivery",)), "1996-01-01", "1996-12-31")
    plan = reports.executive_kpis(rows)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Expand" not in plan
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "orders.parquet" in line and "o_orderdate" in line)
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThanOrEqual(o_orderdate" in scan
    assert "o_orderpriority" not in scan


def test_one_shuffle_serves_a_customers_sequence(spark):
    """Nine features of one customer sequence move the orders once, by customer and hour, and their summary once."""
    t = Entities(spark, FOLDER).using(fact_order="event_order")
    plan = plan_of(order_marts.customer_journey(t, "2024-01-31"))
    assert len(re.findall(r"hashpartitioning\(customer_id#\d+, _seg#\d+", plan)) == 2
    assert len(re.findall(r"hashpartitioning\(customer_id#\d+, \d+", plan)) <= 2  # the summary's window, the customers' join


def test_marts_as_sql_views(spark):
    from silverlode.plans.views import MARTS, register_marts

    t = Entities(spark, FOLDER)
    assert len(MARTS) == 20
    register_marts(t, "2001-08-01", ["mart_order_summary", "mart_restaurant_performance"])
    top = spark.sql("SELECT restaurant_tier, count(*) AS n FROM mart_restaurant_performance GROUP BY restaurant_tier")
    assert sum(r.n for r in top.collect()) == t["supplier"].count()
    orders = spark.sql("SELECT count(DISTINCT order_id) AS n FROM mart_order_summary").first().n
    assert orders == t["orders"].count()
