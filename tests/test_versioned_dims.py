"""Marts read the active version of every versioned dimension."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from silverlode.operators.joins import current
from silverlode.plans import order_marts
from silverlode.sources.driver_tables import Entities

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


class Versioned:
    """The driver tables, with an expired second version of every location and loaded column names."""

    def __init__(self, t):
        self.t = t

    def __getitem__(self, name):
        df = self.t[name]
        if name == "dim_location":
            active = df.withColumn("status", F.lit("ACTIVE"))
            return active.union(active.withColumn("status", F.lit("INACTIVE")))
        return df.withColumnRenamed("address_type", "addresstype") if name == "dim_customer_address" else df

    def __getattr__(self, name):
        return getattr(self.t, name)


def test_versions_do_not_multiply_rows(spark):
    plain = Entities(spark, FOLDER)
    assert current(plain["nation"]).count() == plain["nation"].count()
    for mart in (order_marts.order_fulfillment, order_marts.order_summary):
        assert mart(Versioned(plain)).count() == mart(plain).count()
