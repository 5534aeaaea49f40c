"""Projection, extraction, masking, enrichment and label columns, with their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.catalog import DEFAULT, tags
from silverlode.functions import buckets as b
from silverlode.functions.privacy import mask_columns
from silverlode.functions.scalar import as_timestamp, boundary_diff, digits_to_int, div0
from silverlode.operators import bronze, dims
from silverlode.streaming import events as ev
from workbook.core import EVENT_AS_OF, case
from workbook.delivery import ESTIMATE, MINUTES
from workbook.orders import hour_label, weekend

SOURCE = DEFAULT.source("ORDER_ITEM_BATCH")
ITEM_SQL = """SELECT order_item_id, trim(order_id) AS order_id, try_cast(menu_id AS bigint) AS menu_id, cast(try_cast(quantity AS decimal(10,2)) AS double) AS quantity,
  cast(try_cast(price AS decimal(10,2)) AS double) AS price, cast(try_cast(subtotal AS decimal(10,2)) AS double) AS subtotal, try_cast(order_timestamp AS timestamp) AS order_timestamp"""


def projected(t):
    return bronze.project(t["order_item_raw"].select(*SOURCE.names), SOURCE)


@case("p1_rule_projection", f"{ITEM_SQL} FROM order_item_raw")
def _(t):
    return projected(t).select(*SOURCE.names)


@case("p2_raw_copies", f"{ITEM_SQL}, " + ", ".join(f"{n} AS {n}_raw" for n in SOURCE.names) + " FROM order_item_raw")
def _(t):
    return projected(t).drop("event_ts")


@case("p3_audit_columns", f"SELECT order_item_id, order_id AS order_id_raw, cast(7 AS bigint) AS ingest_run_id, TIMESTAMP '{EVENT_AS_OF}' AS created_at, TIMESTAMP '{EVENT_AS_OF}' AS updated_at FROM order_item_raw")
def _(t):
    rows = bronze.audit(projected(t), 7, as_timestamp(EVENT_AS_OF))
    return rows.select("order_item_id", "order_id_raw", "ingest_run_id", "created_at", "updated_at")


@case("p4_generated_keys", "SELECT count(*) AS row_count, count(DISTINCT concat(order_item_id, '|', src_partkey, '|', src_suppkey)) AS business_keys, count(*) FILTER (order_id <> '') AS given_keys, count(*) AS filled_keys FROM order_item_raw")
def _(t):
    """Rows without an order id get a random one; surrogates are a function of the business key."""
    keyed = t["order_item_raw"].select(
        bronze.surrogate_key(["order_item_id", "src_partkey", "src_suppkey"]).alias("surrogate"),
        F.nullif(F.col("order_id"), F.lit("")).alias("given"),
    ).withColumn("filled", bronze.generated_key("given"))
    return keyed.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("surrogate").alias("business_keys"),
        F.count("given").alias("given_keys"), F.count("filled").alias("filled_keys"),
    )


def messages(t):
    """Purchases as order messages, some with upper-case field names, some with the other status field."""
    key, at = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    body = F.struct(
        F.lit("ORDER_CREATED").alias("event_type"), at.alias("event_timestamp"), key.cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"), (F.col("user_id") % 10).alias("restaurant_id"), at.alias("order_date"),
        F.round("value", 2).alias("total_amount"), F.lit("PLACED").alias("order_status"), F.lit("UPI").alias("payment_method"),
    )
    upper = F.struct(F.lit("ORDER_UPDATED").alias("EVENT_TYPE"), at.alias("EVENT_TIMESTAMP"), key.cast("string").alias("ORDER_ID"), F.lit("READY").alias("STATUS"))
    value = F.when(F.col("event_type") == "purchase", F.to_json(body)).when(F.col("event_type") == "view", F.to_json(upper)).otherwise('{"test": "connection"}')
    return t["events"].select(
        F.lit("orders-events").alias("topic"), (key % 3).cast("int").alias("partition"), key.alias("offset"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"), key.cast("string").alias("key"), value.alias("value"),
    )


@case(
    "p5_event_view",
    """SELECT event_id AS kafka_offset, event_id % 3 AS kafka_partition, ts AS kafka_timestamp, CASE WHEN event_type = 'purchase' THEN 'ORDER_CREATED' ELSE 'ORDER_UPDATED' END AS event_type,
      date_trunc('second', ts) AS event_timestamp, cast(event_id AS varchar) AS order_id, CASE WHEN event_type = 'purchase' THEN cast(user_id AS varchar) END AS customer_id,
      CASE WHEN event_type = 'purchase' THEN user_id % 10 END AS restaurant_id, CASE WHEN event_type = 'purchase' THEN date_trunc('second', ts) END AS order_date,
      CASE WHEN event_type = 'purchase' THEN cast(cast(value AS decimal(10,2)) AS double) END AS total_amount, CASE WHEN event_type = 'purchase' THEN 'PLACED' ELSE 'READY' END AS order_status,
      CASE WHEN event_type = 'purchase' THEN 'UPI' END AS payment_method FROM events WHERE event_type IN ('purchase', 'view')""",
)
def _(t):
    return ev.typed_events(messages(t), "order")


@case(
    "s9_bad_events",
    """SELECT 'ORDER_STREAM' AS pipeline_name, 'orders-events' AS source_table, '{"test": "connection"}' AS record_data, 'TRANSFORMATION' AS error_type, 'message has no valid payload' AS error_message,
      cast(0 AS bigint) AS retry_count, 'PENDING' AS processing_status FROM events WHERE event_type NOT IN ('purchase', 'view')""",
)
def _(t):
    return ev.bad_events(messages(t), "order", "ORDER_STREAM")


@case("t17_newest_events", "SELECT event_id AS message_offset, date_trunc('second', ts) AS event_timestamp FROM events WHERE event_type = 'purchase' ORDER BY date_trunc('second', ts) DESC, event_id LIMIT 20")
def _(t):
    return ev.newest(messages(t), 20).select(F.col("offset").alias("message_offset"), "event_timestamp")


@case("p7_stage", "SELECT order_item_id, src_partkey, src_suppkey, year(try_cast(order_timestamp AS date)) AS ingest_run_id, true AS is_valid FROM order_item_raw WHERE year(try_cast(order_timestamp AS date)) = 1997")
def _(t):
    """Each year's file stands for one run."""
    rows = t["order_item_raw"].withColumn("ingest_run_id", F.year(F.col("order_timestamp").try_cast("date")))
    return bronze.stage(rows, 1997).select("order_item_id", "src_partkey", "src_suppkey", "ingest_run_id", "is_valid")


@case("p8_mask", "SELECT customer_id, customer_name, '** PII **' AS mobile, '** EMAIL **' AS email, login_by_using, '** PII **' AS gender, '** PII **' AS dob FROM dim_customer")
def _(t):
    customers = t["dim_customer"].select("customer_id", "customer_name", "mobile", "email", "login_by_using", "gender", "dob")
    return mask_columns(customers, tags("customer"))


PLACES = [("Mumbai", "Maharashtra"), ("Delhi", "Delhi"), ("Pune", "Maharashtra"), ("Jaipur", "Rajasthan"), ("Guntur", "Andhra Pradesh"), ("Kochi", "Kerala"), ("Leh", "Ladakh")]


@case(
    "p9_location",
    """SELECT c_custkey, city, state, CASE state WHEN 'Maharashtra' THEN 'MH' WHEN 'Delhi' THEN 'DL' WHEN 'Rajasthan' THEN 'RJ' WHEN 'Andhra Pradesh' THEN 'AP' WHEN 'Kerala' THEN 'KL' WHEN 'Ladakh' THEN 'LA' END AS state_code,
      state IN ('Delhi', 'Ladakh') AS is_union_territory, city IN ('Mumbai', 'Delhi', 'Jaipur') AS capital_city_flag,
      CASE WHEN city IN ('Mumbai', 'Delhi', 'Pune') THEN 'TIER1' WHEN city IN ('Jaipur', 'Kochi') THEN 'TIER2' ELSE 'TIER3' END AS city_tier
      FROM (SELECT c_custkey, list_extract(['Mumbai', 'Delhi', 'Pune', 'Jaipur', 'Guntur', 'Kochi', 'Leh'], c_nationkey % 7 + 1) AS city,
              list_extract(['Maharashtra', 'Delhi', 'Maharashtra', 'Rajasthan', 'Andhra Pradesh', 'Kerala', 'Ladakh'], c_nationkey % 7 + 1) AS state FROM customer) x""",
)
def _(t):
    position = F.col("c_nationkey") % 7 + 1
    placed = t["customer"].select(
        "c_custkey", F.element_at(F.array(*[F.lit(c) for c, _ in PLACES]), position).alias("city"),
        F.element_at(F.array(*[F.lit(s) for _, s in PLACES]), position).alias("state"),
    )
    return dims.enrich_location(placed)


@case("p10_digits", "SELECT delivery_id, try_cast(regexp_replace(estimated_time, '[^0-9]', '', 'g') AS bigint) AS minutes, try_cast(regexp_replace(delivery_status, '[^0-9]', '', 'g') AS bigint) AS none FROM fact_delivery")
def _(t):
    return t["fact_delivery"].select("delivery_id", digits_to_int("estimated_time").alias("minutes"), digits_to_int("delivery_status").alias("none"))


HOUR = "hour(order_date)"


@case("p11a_time_of_day", f"SELECT order_id, {hour_label('order_date')} AS time_of_day FROM event_order")
def _(t):
    return t["event_order"].select("order_id", b.time_of_day(F.hour("order_date")).alias("time_of_day"))


@case("p11b_day_type", f"SELECT order_id, {weekend('order_date')} AS day_type, CASE isodow(order_date) WHEN 1 THEN 'MONDAY' WHEN 5 THEN 'FRIDAY' WHEN 6 THEN 'WEEKEND' WHEN 7 THEN 'WEEKEND' ELSE 'MID_WEEK' END AS day_category FROM event_order")
def _(t):
    day = b.iso_weekday(F.to_date("order_date"))
    return t["event_order"].select("order_id", b.day_type(day).alias("day_type"), b.day_category(day).alias("day_category"))


@case(
    "p11c_meal_time",
    f"""SELECT order_id, CASE WHEN {HOUR} BETWEEN 7 AND 10 THEN 'BREAKFAST' WHEN {HOUR} BETWEEN 11 AND 14 THEN 'LUNCH' WHEN {HOUR} BETWEEN 16 AND 18 THEN 'SNACK' WHEN {HOUR} BETWEEN 19 AND 22 THEN 'DINNER' ELSE 'LATE_NIGHT' END AS meal_time,
      CASE WHEN {HOUR} BETWEEN 12 AND 14 THEN 'LUNCH_PEAK' WHEN {HOUR} BETWEEN 19 AND 21 THEN 'DINNER_PEAK' ELSE 'OFF_PEAK' END AS peak_indicator FROM event_order""",
)
def _(t):
    hour = F.hour("order_date")
    return t["event_order"].select("order_id", b.meal_time(hour).alias("meal_time"), b.peak_indicator(hour).alias("peak_indicator"))


@case(
    "p11d_season",
    """SELECT order_id, CASE WHEN month(order_date) IN (12, 1, 2) THEN 'WINTER' WHEN month(order_date) <= 5 THEN 'SPRING' WHEN month(order_date) <= 8 THEN 'SUMMER' ELSE 'FALL' END AS season,
      CASE WHEN day(order_date) <= 10 THEN 'EARLY_MONTH' WHEN day(order_date) <= 20 THEN 'MID_MONTH' ELSE 'END_MONTH' END AS month_period FROM fact_order""",
)
def _(t):
    at = F.col("order_date")
    return t["fact_order"].select("order_id", b.season(F.month(at)).alias("season"), b.month_period(F.dayofmonth(at)).alias("month_period"))


@case(
    "p11e_order_value",
    """SELECT order_id, CASE WHEN total_amount < 200 THEN 'LOW_VALUE' WHEN total_amount < 500 THEN 'MEDIUM_VALUE' WHEN total_amount < 1000 THEN 'HIGH_VALUE' ELSE 'PREMIUM' END AS order_value_segment,
      CASE WHEN payment_method IN ('CREDIT_CARD') THEN 'CARD' ELSE payment_method END AS payment_category FROM event_order""",
)
def _(t):
    return t["event_order"].select(
        "order_id", b.order_value_segment(F.col("total_amount")).alias("order_value_segment"),
        b.payment_category(F.col("payment_method")).alias("payment_category"),
    )


@case(
    "p11f_customer_labels",
    """SELECT customer_id, CASE WHEN n >= 20 THEN 'VIP' WHEN n >= 10 THEN 'LOYAL' WHEN n >= 5 THEN 'REGULAR' WHEN n >= 2 THEN 'REPEAT' ELSE 'NEW' END AS customer_segment,
      CASE WHEN gap <= 30 THEN 'ACTIVE' WHEN gap <= 90 THEN 'AT_RISK' ELSE 'CHURNED' END AS customer_status
      FROM (SELECT customer_id, count(*) AS n, date_diff('day', max(order_date), TIMESTAMP '2001-08-01') AS gap FROM fact_order GROUP BY 1) x""",
)
def _(t):
    counted = t["fact_order"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.max("order_date").alias("last"))
    gap = boundary_diff("day", F.col("last"), as_timestamp("2001-08-01"))
    return counted.select("customer_id", b.customer_segment(F.col("n")).alias("customer_segment"), b.customer_status(gap).alias("customer_status"))


@case(
    "p11g_journey_labels",
    """SELECT order_id, CASE WHEN seq = 1 THEN 'FIRST_ORDER' WHEN seq = 2 THEN 'SECOND_ORDER' WHEN seq <= 5 THEN 'EARLY_ORDERS' WHEN seq <= 10 THEN 'REGULAR_CUSTOMER' ELSE 'LOYAL_CUSTOMER' END AS stage,
      CASE WHEN gap <= 1 THEN 'SAME_DAY' WHEN gap <= 7 THEN 'WITHIN_WEEK' WHEN gap <= 30 THEN 'WITHIN_MONTH' WHEN gap <= 90 THEN 'WITHIN_QUARTER' ELSE 'REACTIVATED' END AS frequency,
      CASE WHEN prev IS NULL THEN 'FIRST_ORDER' WHEN total_amount > prev THEN 'INCREASED' WHEN total_amount < prev THEN 'DECREASED' ELSE 'SAME' END AS trend,
      CASE WHEN next IS NOT NULL THEN 'RETURNED' WHEN late > 90 THEN 'HIGH_CHURN_RISK' WHEN late > 30 THEN 'MEDIUM_CHURN_RISK' ELSE 'LOW_CHURN_RISK' END AS risk
      FROM (SELECT order_id, total_amount, row_number() OVER w AS seq, lag(total_amount) OVER w AS prev, lead(order_date) OVER w AS next,
              date_diff('day', lag(order_date) OVER w, order_date) AS gap, date_diff('day', order_date, TIMESTAMP '2024-01-31') AS late
            FROM event_order WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id)) x""",
)
def _(t):
    from silverlode.operators.sequence import lag, lead, row_number, with_features

    rows = with_features(
        t["event_order"], ["customer_id"], ["order_date", "order_id"],
        [row_number("seq"), lag("prev", "total_amount"), lag("prev_date", "order_date"), lead("next", "order_date")],
    )
    gap = boundary_diff("day", "prev_date", "order_date")
    late = boundary_diff("day", F.col("order_date"), as_timestamp("2024-01-31"))
    return rows.select(
        "order_id", b.journey_stage(F.col("seq")).alias("stage"), b.order_frequency_type(gap).alias("frequency"),
        b.spending_trend(F.col("total_amount"), F.col("prev")).alias("trend"), b.churn_risk(F.col("next"), late).alias("risk"),
    )


@case(
    "p11h_delivery_labels",
    f"""SELECT fd.delivery_id, CASE WHEN {MINUTES} <= {ESTIMATE} THEN 'ON_TIME' WHEN {MINUTES} <= {ESTIMATE} + 10 THEN 'SLIGHTLY_DELAYED' ELSE 'DELAYED' END AS timeliness,
      CASE WHEN {MINUTES} <= {ESTIMATE} THEN 'ON_TIME' WHEN {MINUTES} <= {ESTIMATE} + 10 THEN 'SLIGHTLY_DELAYED' WHEN {MINUTES} <= {ESTIMATE} + 20 THEN 'DELAYED' ELSE 'SEVERELY_DELAYED' END AS detailed,
      CASE WHEN {MINUTES} <= 30 THEN 'FAST' WHEN {MINUTES} <= 45 THEN 'NORMAL' WHEN {MINUTES} <= 60 THEN 'SLOW' ELSE 'VERY_SLOW' END AS speed,
      cast(CASE WHEN fd.delivery_status = 'FAILED' THEN 1 ELSE 0 END AS bigint) AS failed FROM fact_delivery fd""",
)
def _(t):
    actual, estimate = boundary_diff("minute", "created_at", "updated_at"), digits_to_int("estimated_time")
    return t["fact_delivery"].select(
        "delivery_id", b.timeliness(actual, estimate).alias("timeliness"), b.timeliness_detailed(actual, estimate).alias("detailed"),
        b.delivery_speed(actual).alias("speed"), b.flag(F.col("delivery_status") == "FAILED").alias("failed"),
    )


@case(
    "p11i_tiers",
    """SELECT restaurant_id, CASE WHEN ok >= 95 AND n >= 100 THEN 'EXCELLENT' WHEN ok >= 90 THEN 'GOOD' WHEN ok >= 80 THEN 'AVERAGE' ELSE 'NEEDS_IMPROVEMENT' END AS agent_tier,
      CASE WHEN n >= 500 AND v >= 500 THEN 'PLATINUM' WHEN n >= 200 AND v >= 300 THEN 'GOLD' WHEN n >= 50 THEN 'SILVER' ELSE 'BRONZE' END AS restaurant_tier,
      CASE WHEN n >= 50 AND r >= 25000 THEN 'TOP_PERFORMER' WHEN n >= 20 AND r >= 10000 THEN 'HIGH_PERFORMER' WHEN n >= 10 THEN 'AVERAGE_PERFORMER' ELSE 'LOW_PERFORMER' END AS daily_tier
      FROM (SELECT restaurant_id, count(*) AS n, cast(count(*) FILTER (order_status <> 'CANCELLED') AS double) / count(*) * 100 AS ok, sum(total_amount) AS r, cast(sum(total_amount) AS double) / count(*) AS v FROM fact_order GROUP BY 1) x""",
)
def _(t):
    n, r = F.col("n"), F.col("r")
    rows = t["fact_order"].groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("order_status") != "CANCELLED").alias("ok"), F.sum("total_amount").alias("r")
    )
    return rows.select(
        "restaurant_id", b.agent_tier(div0("ok", "n") * 100, n).alias("agent_tier"),
        b.restaurant_tier(n, div0("r", "n")).alias("restaurant_tier"), b.daily_tier(n, r).alias("daily_tier"),
    )


@case(
    "p11j_status_velocity",
    """SELECT o.order_id, CASE WHEN n >= 5 THEN 'HIGH_VELOCITY' WHEN n >= 3 THEN 'NORMAL_VELOCITY' ELSE 'LOW_VELOCITY' END AS velocity,
      CASE WHEN o.order_status <> 'CANCELLED' THEN 'NOT_CANCELLED' WHEN n = 1 THEN 'CANCELLED_IMMEDIATELY' WHEN n <= 3 THEN 'CANCELLED_EARLY' ELSE 'CANCELLED_LATE' END AS stage,
      CASE WHEN o.order_status = 'COMPLETED' AND mins <= 60 THEN 'FAST_COMPLETION' WHEN o.order_status = 'COMPLETED' THEN 'NORMAL_COMPLETION' WHEN o.order_status = 'CANCELLED' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS outcome
      FROM (SELECT *, date_diff('minute', created_at, updated_at) AS mins FROM fact_order) o LEFT JOIN (SELECT order_id, count(*) AS n FROM order_history GROUP BY 1) h ON o.order_id = h.order_id""",
)
def _(t):
    changes = t["order_history"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    status, n = F.col("order_status"), F.col("n")
    minutes = boundary_diff("minute", "created_at", "updated_at")
    return t["fact_order"].join(changes, "order_id", "left").select(
        "order_id", b.status_velocity(n).alias("velocity"), b.cancellation_stage(status, n).alias("stage"), b.order_outcome(status, minutes).alias("outcome")
    )


@case(
    "p12_predicates",
    "SELECT order_id, order_status, restaurant_id FROM fact_order WHERE order_status IN ('COMPLETED', 'PENDING') AND payment_method NOT IN ('CASH') AND order_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' AND (payment_method LIKE 'U%' OR restaurant_id IS NULL)",
)
def _(t):
    method = F.col("payment_method")
    return t["fact_order"].where(
        F.col("order_status").isin("COMPLETED", "PENDING") & ~method.isin("CASH")
        & F.col("order_date").between(as_timestamp("1996-01-01"), as_timestamp("1998-12-31"))
        & (method.like("U%") | F.col("restaurant_id").isNull())
    ).select("order_id", "order_status", "restaurant_id")


UNITS = ["year", "month", "day", "hour", "minute", "second"]


@case(
    "p14_boundary_diff",
    "SELECT user_id, event_id, " + ", ".join(f"date_diff('{u}', prev, ts) AS {u}s" for u in UNITS)
    + " FROM (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) x",
)
def _(t):
    from silverlode.operators.sequence import lag, with_features

    rows = with_features(t["events"], ["user_id"], ["ts", "event_id"], [lag("prev", "ts")])
    return rows.select("user_id", "event_id", *[boundary_diff(u, "prev", "ts").alias(f"{u}s") for u in UNITS])


@case("p15_ratio", "SELECT ingest_run_id, CASE WHEN invalid_row_count = 0 THEN 0.0::double ELSE cast(valid_row_count AS double) / invalid_row_count END AS ratio FROM ingest_run")
def _(t):
    return t["ingest_run"].select("ingest_run_id", div0("valid_row_count", "invalid_row_count").alias("ratio"))
