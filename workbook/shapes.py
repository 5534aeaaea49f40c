"""Join, aggregation, window, sort and set forms, with their checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from silverlode.functions.scalar import as_timestamp, most_common
from silverlode.operators import dims, joins
from silverlode.operators.sequence import lag, lead, moving_average, row_number, running, with_features
from silverlode.streaming.monitors import order_completeness
from workbook.core import ORDER_AS_OF, case

DAILY = "SELECT restaurant_id, cast(order_date AS date) AS order_day, count(*) AS orders, sum(total_amount) AS revenue FROM fact_order GROUP BY ALL"


def daily(t):
    return t["fact_order"].groupBy("restaurant_id", F.to_date("order_date").alias("order_day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue")
    )


@case("j1_inner", "SELECT o.order_id, c.customer_name, r.restaurant_name FROM fact_order o JOIN dim_customer c ON o.customer_id = c.customer_id JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id")
def _(t):
    rows = joins.lookup(t["fact_order"], joins.current(t["dim_customer"]), "customer_id", ["customer_name"], "inner")
    return joins.lookup(rows, joins.current(t["dim_restaurant"]), "restaurant_id", ["restaurant_name"], "inner").select("order_id", "customer_name", "restaurant_name")


@case("j2_left_with_predicate", "SELECT c.customer_id, o.order_id FROM dim_customer c LEFT JOIN fact_order o ON c.customer_id = o.customer_id AND o.order_status = 'CANCELLED' AND o.payment_method = 'CASH'")
def _(t):
    cancelled = t["fact_order"].where((F.col("order_status") == "CANCELLED") & (F.col("payment_method") == "CASH"))
    return t["dim_customer"].select("customer_id").join(cancelled.select("customer_id", "order_id"), "customer_id", "left")


@case(
    "j3_star",
    """SELECT o.order_id, c.customer_name, r.restaurant_name, l.city, fd.delivery_id, da.vehicle_type FROM fact_order o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
      LEFT JOIN dim_restaurant r ON o.restaurant_id = r.restaurant_id LEFT JOIN dim_location l ON r.location_id = l.location_id LEFT JOIN fact_delivery fd ON o.order_id = fd.order_id
      LEFT JOIN dim_delivery_agent da ON fd.delivery_agent_id = da.delivery_agent_id""",
)
def _(t):
    places = joins.lookup(t["dim_restaurant"], t["dim_location"], "location_id", ["city"])
    rows = t["fact_order"].select("order_id", "customer_id", "restaurant_id")
    rows = joins.lookup(rows, t["fact_delivery"], "order_id", ["delivery_id", "delivery_agent_id"])
    rows = joins.lookup(rows, t["dim_customer"], "customer_id", ["customer_name"])
    rows = joins.lookup(rows, places, "restaurant_id", ["restaurant_name", "city"])
    rows = joins.lookup(rows, t["dim_delivery_agent"], "delivery_agent_id", ["vehicle_type"])
    return rows.select("order_id", "customer_name", "restaurant_name", "city", "delivery_id", "vehicle_type")


@case("j4_calendar_join", "SELECT order_id, year(order_date) AS year, week(order_date) AS week, isodow(order_date) AS day_of_week, left(dayname(order_date), 3) AS day_name FROM fact_order")
def _(t):
    orders = t["fact_order"]
    calendar = dims.date_dimension(dims.date_range(orders, "order_date", as_timestamp(ORDER_AS_OF)))
    keyed = orders.select("order_id", F.to_date("order_date").alias("calendar_date"))
    return joins.lookup(keyed, calendar, "calendar_date", ["year", "week", "day_of_week", "day_name"]).drop("calendar_date")


@case(
    "j5_wildcard_join",
    """SELECT r.ingest_run_id, r.pipeline_name, c.label FROM ingest_run r JOIN (SELECT concat('PIPELINE_', cast(r_regionkey AS varchar)) AS name, r_name AS label FROM region WHERE r_regionkey < 3
        UNION ALL SELECT 'ALL', 'EVERYWHERE') c ON r.pipeline_name = c.name OR c.name = 'ALL'""",
)
def _(t):
    named = t["region"].where("r_regionkey < 3").select(
        F.concat(F.lit("PIPELINE_"), F.col("r_regionkey").cast("string")).alias("pipeline_name"), F.col("r_name").alias("label")
    )
    config = named.unionByName(t["region"].agg(F.lit("ALL").alias("pipeline_name"), F.lit("EVERYWHERE").alias("label")))
    runs = t["ingest_run"].select("ingest_run_id", "pipeline_name").withColumn("name", F.col("pipeline_name"))
    return joins.wildcard_join(runs, config.withColumnRenamed("pipeline_name", "name"), "name").select("ingest_run_id", "pipeline_name", "label")


@case(
    "j6_city_grain",
    """SELECT a.customer_address_id, a.city, g.state, g.city_tier FROM dim_customer_address a LEFT JOIN (SELECT city, min(state) AS state, min(city_tier) AS city_tier FROM dim_location GROUP BY city) g ON a.city = g.city""",
)
def _(t):
    """Locations twice, as two zip codes of each city: still one row per address."""
    locations = t["dim_location"].unionByName(t["dim_location"].withColumn("location_id", F.col("location_id") + 1000))
    addresses = t["dim_customer_address"].select("customer_address_id", "city")
    return joins.lookup(addresses, dims.city_grain(locations), "city", ["state", "city_tier"])


@case("j7_anti", "SELECT order_id, total_amount FROM (SELECT order_id, cast(total_amount AS double) AS total_amount FROM fact_order o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE cast(l_orderkey AS varchar) = o.order_id)) x")
def _(t):
    items = t["lineitem"].select(F.col("l_orderkey").cast("string").alias("order_id"))
    return t["fact_order"].join(items, "order_id", "left_anti").select("order_id", "total_amount")


@case("j8_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def _(t):
    dear = t["orders"].where(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return t["customer"].join(dear, "c_custkey", "left_semi").select("c_custkey", "c_name")


COMPLETENESS = """SELECT o.order_id, o.customer_id, cast(o.total_amount AS double) AS total_amount, o.order_status, count(DISTINCT oi.order_item_id) AS item_count, d.delivery_id, d.delivery_status, d.delivery_agent_id
  FROM fact_order o LEFT JOIN fact_order_item oi ON o.order_id = oi.order_id LEFT JOIN fact_delivery d ON o.order_id = d.order_id GROUP BY ALL"""


@case("j11_completeness", COMPLETENESS)
def _(t):
    return order_completeness(t["fact_order"], t["fact_order_item"], t["fact_delivery"], None)


@case("j12_scalar_subqueries", "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS items, (SELECT count(DISTINCT o_custkey) FROM orders) AS buyers, (SELECT count(*) FROM customer) AS customers")
def _(t):
    counted = {"items": t["lineitem"].agg(F.count(F.lit(1))), "customers": t["customer"].agg(F.count(F.lit(1)))}
    head = t["orders"].agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("buyers"))
    return head.select("*", *[frame.scalar().alias(name) for name, frame in counted.items()])


@case("a1_aggregate", "SELECT l_returnflag, l_linestatus, count(*) AS n, cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total, cast(min(l_quantity) AS double) AS low, cast(max(l_quantity) AS double) AS high, count(DISTINCT l_suppkey) AS sellers, count(DISTINCT l_orderkey) AS orders, count(*) FILTER (l_discount > 0.05) AS discounted, count(DISTINCT CASE WHEN l_tax > 0.04 THEN l_partkey END) AS taxed_parts FROM lineitem GROUP BY ALL")
def _(t):
    return t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"), F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"), F.count_distinct("l_suppkey").alias("sellers"), F.count_distinct("l_orderkey").alias("orders"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.count_distinct(F.when(F.col("l_tax") > 0.04, F.col("l_partkey"))).alias("taxed_parts"),
    )


@case("a5_mode", "SELECT customer_id, payment_method AS preferred FROM (SELECT customer_id, payment_method, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, payment_method) AS rn FROM fact_order GROUP BY customer_id, payment_method) x WHERE rn = 1")
def _(t):
    return most_common(t["fact_order"], ["customer_id"], "payment_method", "preferred")


@case("a6_stddev", "SELECT pipeline_name, round(stddev(cast(execution_duration_sec AS double)), 6) AS spread FROM ingest_run GROUP BY 1")
def _(t):
    return t["ingest_run"].groupBy("pipeline_name").agg(F.round(F.stddev(F.col("execution_duration_sec").cast("double")), 6).alias("spread"))


@case("a8_ordered_list", "SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY 1")
def _(t):
    return t["part"].groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("p_type")), ", ").alias("types"))


@case("a10_having", "SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1 HAVING count(*) >= 8")
def _(t):
    return t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines")).where("lines >= 8")


@case("a13_group_sizes", "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def _(t):
    return t["events"].groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))


WEEK = f"""SELECT restaurant_id, order_day, orders, lag(orders, 7) OVER w AS week_ago, lag(orders) OVER w AS day_ago, lead(orders) OVER w AS next_day, row_number() OVER w AS position,
  CASE WHEN lag(orders, 7) OVER w = 0 THEN 0.0 ELSE cast(orders - lag(orders, 7) OVER w AS double) / lag(orders, 7) OVER w END * 100 AS growth_pct FROM ({DAILY}) d WINDOW w AS (PARTITION BY restaurant_id ORDER BY order_day)"""


@case("w5_lag7", WEEK)
def _(t):
    rows = with_features(
        daily(t).drop("revenue"), ["restaurant_id"], ["order_day"],
        [lag("week_ago", "orders", 7), lag("day_ago", "orders"), lead("next_day", "orders"), row_number("position")], bounded=True,
    )
    from silverlode.functions.scalar import percent

    return rows.withColumn("growth_pct", percent(F.col("orders") - F.col("week_ago"), "week_ago"))


@case(
    "w8_ma7",
    f"""SELECT restaurant_id, order_day, cast(sum(orders) OVER m AS double) / count(*) OVER m AS ma7_orders, cast(sum(revenue) OVER r AS double) AS revenue_to_date FROM ({DAILY}) d
      WINDOW m AS (PARTITION BY restaurant_id ORDER BY order_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), r AS (PARTITION BY restaurant_id ORDER BY order_day ROWS UNBOUNDED PRECEDING)""",
)
def _(t):
    rows = with_features(
        daily(t), ["restaurant_id"], ["order_day"], [moving_average("ma7_orders", "orders", 7), running("revenue_to_date", "sum", "revenue")], bounded=True
    )
    return rows.select("restaurant_id", "order_day", "ma7_orders", "revenue_to_date")


@case("w3_dense_rank", f"SELECT restaurant_id, order_day, dense_rank() OVER (PARTITION BY order_day ORDER BY orders DESC) AS day_rank FROM ({DAILY}) d")
def _(t):
    by_day = Window.partitionBy("order_day").orderBy(F.col("orders").desc())
    return daily(t).select("restaurant_id", "order_day", F.dense_rank().over(by_day).alias("day_rank"))


@case("w6_first_value", f"SELECT restaurant_id, order_day, first_value(orders) OVER (PARTITION BY restaurant_id ORDER BY order_day) AS first_orders FROM ({DAILY}) d")
def _(t):
    by_day = Window.partitionBy("restaurant_id").orderBy("order_day")
    return daily(t).select("restaurant_id", "order_day", F.first("orders").over(by_day).alias("first_orders"))


@case("w9_month_to_date", f"SELECT restaurant_id, order_day, cast(sum(orders) OVER (PARTITION BY restaurant_id, date_trunc('month', order_day) ORDER BY order_day) AS bigint) AS mtd_orders FROM ({DAILY}) d")
def _(t):
    rows = daily(t).withColumn("month", F.trunc("order_day", "month"))
    return with_features(rows, ["restaurant_id", "month"], ["order_day"], [running("mtd_orders", "sum", "orders")], bounded=True).select("restaurant_id", "order_day", "mtd_orders")


@case("w11_distinct_window", "SELECT order_id, count(DISTINCT payment_method) OVER (PARTITION BY customer_id) AS methods FROM fact_order")
def _(t):
    return joins.distinct_in_group(t["fact_order"], ["customer_id"], "payment_method", "methods").select("order_id", "methods")


@case("w10_group_average", "SELECT order_id, cast(sum(total_amount) OVER (PARTITION BY payment_method) AS double) / count(*) OVER (PARTITION BY payment_method) AS method_average, count(*) OVER (PARTITION BY payment_method) AS method_orders FROM fact_order")
def _(t):
    from silverlode.functions.scalar import mean

    rows = joins.group_totals(t["fact_order"], ["payment_method"], mean("total_amount").alias("method_average"), F.count(F.lit(1)).alias("method_orders"))
    return rows.select("order_id", "method_average", "method_orders")


@case("w12_share", "SELECT cast(c_nationkey AS bigint) AS c_nationkey, c_mktsegment, cast(count(*) AS double) / cast(sum(count(*)) OVER (PARTITION BY customer.c_nationkey) AS double) * 100 AS share_pct FROM customer GROUP BY customer.c_nationkey, c_mktsegment")
def _(t):
    from silverlode.functions.scalar import percent

    grouped = t["customer"].groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return grouped.select("c_nationkey", "c_mktsegment", percent("n", F.sum("n").over(Window.partitionBy("c_nationkey"))).alias("share_pct"))


@case("w13_topk", "SELECT customer_id, order_id, row_number() OVER (PARTITION BY customer_id ORDER BY total_amount DESC, order_id) AS position FROM fact_order QUALIFY position <= 3")
def _(t):
    top = joins.top_per_group(t["fact_order"], ["customer_id"], [F.col("total_amount").desc(), F.col("order_id")], 3, "position")
    return top.select("customer_id", "order_id", "position")


@case("w14_duplicate_numbers", "SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, row_number() OVER (PARTITION BY l_orderkey, lineitem.l_linenumber ORDER BY l_partkey, l_suppkey) AS copy, count(*) OVER (PARTITION BY l_orderkey, lineitem.l_linenumber) AS copies FROM lineitem")
def _(t):
    from silverlode.operators.sequence import total

    keys = ["l_orderkey", "l_linenumber"]
    rows = with_features(t["lineitem"], keys, ["l_partkey", "l_suppkey"], [row_number("copy"), total("copies", "count", "l_partkey")], bounded=True)
    return rows.select(*keys, "copy", "copies")


@case("o2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(t):
    return t["orders"].select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(50)


@case("o3_distinct", "SELECT DISTINCT pipeline_name, processing_status FROM dead_letter")
def _(t):
    return t["dead_letter"].select("pipeline_name", "processing_status").distinct().orderBy("pipeline_name", "processing_status")


@case("o4_union_all", "SELECT 'ORDER' AS kind, order_id AS id FROM fact_order UNION ALL SELECT 'ITEM', order_item_id FROM fact_order_item UNION ALL SELECT 'DELIVERY', delivery_id FROM fact_delivery")
def _(t):
    kinds = {"ORDER": ("fact_order", "order_id"), "ITEM": ("fact_order_item", "order_item_id"), "DELIVERY": ("fact_delivery", "delivery_id")}
    parts = [t[table].select(F.lit(kind).alias("kind"), F.col(key).alias("id")) for kind, (table, key) in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@case("o5_split_list", "SELECT p_partkey, trim(unnest(string_split(concat(p_name, ', ', p_brand, ' , ', p_type), ','))) AS item FROM part")
def _(t):
    listed = t["part"].select("p_partkey", F.concat("p_name", F.lit(", "), "p_brand", F.lit(" , "), "p_type").alias("names"))
    return joins.split_list(listed, "names", "item").select("p_partkey", "item")
