"""Large dimensions are joined where rows are few: customers to orders, not to their deliveries."""

from pathlib import Path

import pytest

from silverlode.plans import order_marts
from silverlode.sources.driver_tables import Entities

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


def test_customers_and_addresses_move_no_joined_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        lines = order_marts.order_fulfillment(Entities(spark, FOLDER))._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields"):
            spark.conf.unset(name)
    moved = {"customer_id": [], "customer_address_id": []}
    for place, line in enumerate(lines):
        for key, found in moved.items():
            if f"Exchange hashpartitioning({key}#" in line:
                found.append(next(n for n in lines[place + 1:] if "Project [" in n))
    assert len(moved["customer_id"]) >= 2
    assert not [n for n in moved["customer_id"] if "delivery_id" in n]
    assert not [n for n in moved["customer_address_id"] if "order_date" in n]
