"""The business entities, derived from the driver's parquet tables.

``Entities(spark, folder)`` is a read-only mapping: raw tables by their file
name, entities by their table name.  Nothing is read before it is asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.operators.history import transitions
from silverlode.operators.joins import top_per_group

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# How the driver's codes stand for business states.
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "UPI",
    "2-HIGH": "CREDIT_CARD",
    "3-MEDIUM": "CASH",
    "4-NOT SPECIFIED": "WALLET",
}
STATUS_BY_EVENT = {
    "click": "PENDING",
    "view": "CONFIRMED",
    "signup": "PREPARING",
    "purchase": "READY",
    "error": "OUT_FOR_DELIVERY",
}


def _choose(value: Column, labels: Mapping, default: str | None = None) -> Column:
    label = F.lit(default)
    for key, name in labels.items():
        label = F.when(value == key, name).otherwise(label)
    return label


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _minutes(value: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), value.cast("int"))


def _money(name: str, kind: str = "decimal(18,2)") -> Column:
    return F.col(name).cast(kind)


def _active() -> Column:
    return F.lit("ACTIVE").alias("status")


def fact_order_item(t: Mapping[str, DataFrame]) -> DataFrame:
    """Line items with duplicates removed: the lowest row of each key stays."""
    order = [
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    first = top_per_group(t["lineitem"], ["l_orderkey", "l_linenumber"], [F.col(c) for c in order], 1, "_rn")
    return first.select(
        F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber")).alias("order_item_id"),
        _text("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("menu_id"),
        F.col("l_suppkey").alias("restaurant_id"),
        _money("l_quantity", "decimal(10,2)").alias("quantity"),
        _money("l_extendedprice").alias("subtotal"),
        F.to_date("l_shipdate").alias("ship_date"),
        "l_returnflag",
        "l_linestatus",
        "l_orderkey",
        "l_linenumber",
    )


def fact_order(t: Mapping[str, DataFrame]) -> DataFrame:
    first_seller = t["lineitem"].groupBy("l_orderkey").agg(F.min("l_suppkey").alias("restaurant_id"))
    orders = t["orders"].join(first_seller, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        "restaurant_id",
        F.col("o_orderdate").alias("order_date"),
        _money("o_totalprice").alias("total_amount"),
        _choose(F.col("o_orderstatus"), {"F": "COMPLETED", "O": "PENDING"}, "CANCELLED").alias("order_status"),
        _choose(F.col("o_orderpriority"), PAYMENT_BY_PRIORITY, "NET_BANKING").alias("payment_method"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_orderdate") + _minutes(F.col("o_orderkey") % 120)).alias("updated_at"),
        _active(),
    )


def dim_customer(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("c_custkey")
    return t["customer"].select(
        _text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("9"), F.lpad(_text("c_custkey"), 9, "0")).alias("mobile"),
        F.concat(F.lit("c"), _text("c_custkey"), F.lit("@mail.test")).alias("email"),
        F.col("c_mktsegment").alias("login_by_using"),
        _choose(key % 3, {0: "MALE", 1: "FEMALE"}, "OTHER").alias("gender"),
        F.date_add(F.lit("1960-01-01").cast("date"), (key % 16000).cast("int")).alias("dob"),
        F.concat(F.lit('{"segment":"'), F.col("c_mktsegment"), F.lit('"}')).alias("preferences"),
        F.col("c_nationkey").alias("location_id"),
        _active(),
    )


def dim_restaurant(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("s_suppkey")
    cuisine = {0: "NORTH INDIAN", 1: "SOUTH INDIAN", 2: "CHINESE", 3: "ITALIAN"}
    return t["supplier"].select(
        key.alias("restaurant_id"),
        F.col("s_name").alias("restaurant_name"),
        _choose(key % 5, cuisine, "CAFE").alias("cuisine_type"),
        (300 + (key % 9) * 100).cast("decimal(10,2)").alias("pricing_for_two"),
        F.concat(F.lit("AREA_"), (key % 7).cast("string")).alias("locality"),
        _choose(key % 4, {0: "CLOSED"}, "OPEN").alias("open_status"),
        F.col("s_nationkey").alias("location_id"),
        _active(),
    )


def dim_menu(t: Mapping[str, DataFrame]) -> DataFrame:
    sellers = t["supplier"].agg(F.count(F.lit(1))).scalar()
    return t["part"].select(
        F.col("p_partkey").alias("menu_id"),
        (F.col("p_partkey") % sellers).alias("restaurant_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        _money("p_retailprice", "decimal(10,2)").alias("price"),
        F.col("p_brand").alias("item_type"),
        _choose(F.col("p_size") % 10, {0: "UNAVAILABLE"}, "AVAILABLE").alias("availability"),
        _active(),
    )


def dim_location(t: Mapping[str, DataFrame]) -> DataFrame:
    placed = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    region = F.col("r_regionkey")
    return placed.select(
        F.col("n_nationkey").alias("location_id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.when(region <= 1, "TIER1").when(region == 2, "TIER2").otherwise("TIER3").alias("city_tier"),
        (100000 + F.col("n_nationkey") * 37).cast("string").alias("zip_code"),
    )


def dim_delivery_agent(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("s_suppkey")
    return t["supplier"].select(
        key.alias("delivery_agent_id"),
        F.col("s_name").alias("delivery_agent_name"),
        F.concat(F.lit("8"), F.lpad(key.cast("string"), 9, "0")).alias("phone"),
        _choose(key % 4, {0: "BIKE", 1: "SCOOTER", 2: "BICYCLE"}, "CAR").alias("vehicle_type"),
        _choose(key % 2, {0: "MALE"}, "FEMALE").alias("gender"),
        ((35 + key % 16) / 10).cast("decimal(2,1)").alias("rating"),
        F.col("s_nationkey").alias("location_id"),
        _active(),
    )


def dim_customer_address(t: Mapping[str, DataFrame]) -> DataFrame:
    placed = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return placed.select(
        F.col("c_custkey").alias("customer_address_id"),
        _text("c_custkey").alias("customer_id"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("AREA_"), (F.col("c_custkey") % 7).cast("string")).alias("locality"),
        (100000 + F.col("c_nationkey") * 37).cast("string").alias("zipcode"),
        _choose(F.col("c_custkey") % 3, {0: "HOME", 1: "WORK"}, "OTHER").alias("address_type"),
        _active(),
    )


def fact_delivery(t: Mapping[str, DataFrame]) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("long")
    buyers = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_address_id"))
    started = F.col("ship_date").cast("timestamp_ntz") + _minutes((order * 7 + line * 31) % 1440)
    return t["fact_order_item"].join(buyers, "l_orderkey", "left").select(
        F.col("order_item_id").alias("delivery_id"),
        "order_id",
        F.col("restaurant_id").alias("delivery_agent_id"),
        _choose(F.col("l_returnflag"), {"A": "DELIVERED", "R": "FAILED"}, "IN_TRANSIT").alias("delivery_status"),
        F.concat(F.col("quantity").cast("int").cast("string"), F.lit(" mins")).alias("estimated_time"),
        "customer_address_id",
        started.alias("delivery_date"),
        started.alias("created_at"),
        (started + _minutes((order * 13 + line * 17) % 60)).alias("updated_at"),
        _active(),
    )


def event_order(t: Mapping[str, DataFrame]) -> DataFrame:
    """Purchases as orders: unlike the order table they carry a time of day."""
    key = F.col("event_id")
    payment = {0: "UPI", 1: "CREDIT_CARD", 2: "CASH", 3: "WALLET"}
    return t["events"].where(F.col("event_type") == "purchase").select(
        _text("event_id").alias("order_id"),
        _text("user_id").alias("customer_id"),
        (F.col("user_id") % 10).alias("restaurant_id"),
        F.col("ts").alias("order_date"),
        _money("value").alias("total_amount"),
        _choose(key % 3, {0: "COMPLETED", 1: "PENDING"}, "CANCELLED").alias("order_status"),
        _choose(key % 5, payment, "NET_BANKING").alias("payment_method"),
        F.col("ts").alias("created_at"),
        (F.col("ts") + _minutes(key % 120)).alias("updated_at"),
        _active(),
    )


def status_history(t: Mapping[str, DataFrame]) -> DataFrame:
    """Status changes per user: each event type stands for one status."""
    seen = t["events"].select(
        F.col("user_id").alias("entity_id"),
        _choose(F.col("event_type"), STATUS_BY_EVENT).alias("status"),
        "ts",
        "event_id",
    )
    return transitions(seen, "entity_id", "status", "ts", ["event_id"])


def order_history(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["status_history"].select(
        _text("entity_id").alias("order_id"), "old_status", "new_status", "status_changed_at"
    )


def delivery_history(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["status_history"].select(
        F.concat(_text("entity_id"), F.lit("-1")).alias("delivery_id"), "old_status", "new_status", "status_changed_at"
    )


def _worker() -> Column:
    return F.concat(F.lit("PIPELINE_"), (F.col("user_id") % 5).cast("string")).alias("pipeline_name")


def ingest_run(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("event_id")
    return t["events"].select(
        key.alias("ingest_run_id"),
        _worker(),
        _choose(F.col("event_type"), {"error": "FAILED"}, "SUCCESS").alias("run_status"),
        (100 + key % 50).alias("source_row_count"),
        (100 + key % 50 - key % 7).alias("valid_row_count"),
        (key % 7).alias("invalid_row_count"),
        _money("value").alias("execution_duration_sec"),
        F.col("ts").alias("executed_at"),
    )


def dead_letter(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("event_id")
    states = {0: "PENDING", 1: "RETRYING", 2: "RESOLVED"}
    return t["events"].where(F.col("event_type") == "error").select(
        key.alias("dlq_id"),
        _worker(),
        _choose(key % 3, {0: "TECHNICAL", 1: "TRANSFORMATION"}, "REFERENTIAL").alias("error_type"),
        F.col("props").alias("record_data"),
        _choose(F.floor(key / 7) % 4, states, "ABANDONED").alias("processing_status"),
        (key % 4).alias("retry_count"),
        F.when(key % 4 > 0, F.col("ts") + _minutes((key % 4) * 10)).alias("last_retry_at"),
        F.col("ts").alias("created_at"),
    )


def alerts(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("event_id")
    return t["events"].where(F.col("event_type") == "error").select(
        key.alias("alert_id"),
        _worker(),
        _choose(key % 2, {0: "SLA_BREACH"}, "DEGRADATION").alias("alert_type"),
        _choose(key % 3, {0: "CRITICAL"}, "WARNING").alias("severity"),
        _choose(key % 2, {0: "QUALITY"}, "PERFORMANCE").alias("metric_name"),
        _money("value", "decimal(10,2)").alias("actual_value"),
        F.lit(95).cast("decimal(10,2)").alias("threshold_value"),
        F.concat(F.lit("Event "), key.cast("string")).alias("alert_message"),
        _choose(F.floor(key / 7) % 4, {0: "RESOLVED"}, "OPEN").alias("alert_status"),
        F.col("ts").alias("detected_at"),
    )


def order_item_raw(t: Mapping[str, DataFrame]) -> DataFrame:
    """Line items as text with real duplicate keys: the input of the quality checks."""
    part, seller = F.col("l_partkey"), F.col("l_suppkey")
    price = _money("l_extendedprice")
    amount = F.col("l_quantity").cast("int")
    subtotal = (price * amount).cast("decimal(18,2)")
    return t["lineitem"].select(
        F.concat(_text("l_orderkey"), F.lit("-"), _text("l_linenumber")).alias("order_item_id"),
        F.when(part % 50 == 0, "").otherwise(_text("l_orderkey")).alias("order_id"),
        F.when(seller % 33 == 0, "NULL").otherwise(_text("l_partkey")).alias("menu_id"),
        F.when(part % 97 == 0, "0").otherwise(amount.cast("string")).alias("quantity"),
        price.cast("string").alias("price"),
        F.when(part % 41 == 0, (subtotal + 1).cast("decimal(18,2)")).otherwise(subtotal).cast("string").alias("subtotal"),
        F.when(part % 61 == 0, "unknown").otherwise(F.to_date("l_shipdate").cast("string")).alias("order_timestamp"),
        part.alias("src_partkey"),
        seller.alias("src_suppkey"),
    )


def _seconds(value: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), value.cast("decimal(18,6)"))


def landed_order(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("event_id")
    return t["events"].where(F.col("event_type") == "purchase").select(
        _text("event_id").alias("order_id"),
        _text("user_id").alias("customer_id"),
        _money("value").alias("total_amount"),
        _choose(key % 3, {0: "COMPLETED", 1: "PENDING"}, "CANCELLED").alias("order_status"),
        key.alias("kafka_offset"),
        F.col("ts").alias("kafka_timestamp"),
        (F.col("ts") + _seconds(key % 400)).alias("ingested_at"),
        (key % 4 != 0).alias("processed_to_gold"),
    )


def gold_order(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("kafka_offset")
    return t["landed_order"].where("processed_to_gold").select(
        "order_id", "customer_id", "total_amount", "order_status",
        (F.col("ingested_at") + _seconds(key % 90)).alias("created_at"),
        F.concat(F.lit("STREAM_"), (key % 20).cast("string")).alias("batch_id"),
    )


def landed_item(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["fact_order_item"].select(
        "order_item_id", "order_id", (F.col("ship_date").cast("timestamp_ntz") + _seconds(F.col("l_orderkey") % 300)).alias("ingested_at")
    )


def landed_delivery(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["fact_delivery"].select("delivery_id", "order_id", F.col("delivery_date").alias("ingested_at"))


ENTITIES: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    fn.__name__: fn
    for fn in (
        fact_order_item, fact_order, dim_customer, dim_restaurant, dim_menu, dim_location, dim_delivery_agent,
        dim_customer_address, fact_delivery, event_order, status_history, order_history, delivery_history,
        ingest_run, dead_letter, alerts, order_item_raw, landed_order, gold_order, landed_item, landed_delivery,
    )
}


class Entities(Mapping[str, DataFrame]):
    def __init__(self, spark: SparkSession, folder: str, overlay: Mapping[str, str] | None = None):
        self.spark, self.folder, self.overlay = spark, folder, dict(overlay or {})

    def __getitem__(self, name: str) -> DataFrame:
        name = self.overlay.get(name, name)
        if name in RAW_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return ENTITIES[name](self)

    def __iter__(self) -> Iterator[str]:
        return iter([*RAW_TABLES, *ENTITIES])

    def __len__(self) -> int:
        return len(RAW_TABLES) + len(ENTITIES)

    def using(self, **overlay: str) -> Entities:
        """The same tables with some names standing for others (``fact_order='event_order'``)."""
        return Entities(self.spark, self.folder, {**self.overlay, **overlay})
