"""Upserts, versioned tables, histories and dimensions, with their checks.

Customers arrive in four batches: all but one segment; that segment and a
changed one; the same batch again (changes nothing); a second change of a part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.functions.scalar import as_timestamp, row_hash
from silverlode.operators import dims, history, merge, scd2
from silverlode.session import materialize
from workbook.core import EVENT_AS_OF, ORDER_AS_OF, case

KEYS = ["customer_id"]
TRACKED = ["customer_id", "customer_name", "login_by_using", "location_id"]
DAYS = ["2001-01-01 00:00:00", "2001-02-01 00:00:00", "2001-03-01 00:00:00", "2001-04-01 00:00:00"]

def segment():
    return F.col("login_by_using")


def batches(t):
    customers = t["dim_customer"].select(*TRACKED)
    first = customers.where(segment() != "BUILDING")
    second = customers.where(segment().isin("BUILDING", "MACHINERY")).withColumn("login_by_using", F.concat(segment(), F.lit("_V2")))
    last = customers.where((segment() == "MACHINERY") & (F.col("location_id") < 10)).withColumn(
        "login_by_using", F.concat(segment(), F.lit("_V3"))
    )
    return [first, second, second, last]


def stamped(t, number):
    return merge.stamp(batches(t)[number], f"BATCH_{number + 1}", as_timestamp(DAYS[number]))


def sql_batch(number: int) -> str:
    """Batch rows as a subquery."""
    text = [
        "login_by_using AS login_by_using, location_id FROM dim_customer WHERE login_by_using <> 'BUILDING'",
        "concat(login_by_using, '_V2') AS login_by_using, location_id FROM dim_customer WHERE login_by_using IN ('BUILDING', 'MACHINERY')",
        "",
        "concat(login_by_using, '_V3') AS login_by_using, location_id FROM dim_customer WHERE login_by_using = 'MACHINERY' AND location_id < 10",
    ]
    return f"(SELECT customer_id, customer_name, {text[1 if number == 2 else number]})"


@case(
    "u1_merge",
    f"""SELECT coalesce(b.customer_id, a.customer_id) AS customer_id, coalesce(b.customer_name, a.customer_name) AS customer_name, coalesce(b.login_by_using, a.login_by_using) AS login_by_using,
      cast(coalesce(b.location_id, a.location_id) AS bigint) AS location_id, CASE WHEN b.customer_id IS NULL THEN 'BATCH_1' ELSE 'BATCH_2' END AS batch_id,
      CASE WHEN a.customer_id IS NULL THEN TIMESTAMP '{DAYS[1]}' ELSE TIMESTAMP '{DAYS[0]}' END AS created_at,
      CASE WHEN b.customer_id IS NULL THEN TIMESTAMP '{DAYS[0]}' ELSE TIMESTAMP '{DAYS[1]}' END AS updated_at
      FROM {sql_batch(0)} a FULL JOIN {sql_batch(1)} b ON a.customer_id = b.customer_id""",
)
def _(t):
    return merge.upsert(stamped(t, 0), stamped(t, 1), KEYS)


@case(
    "u1_merge_late_events",
    """SELECT user_id, event_id, ts AS event_ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""",
)
def _(t):
    """Purchases arrive after the other events, some of them older: the newest row per user stays."""
    seen = t["events"].select("user_id", "event_id", F.col("ts").alias("event_ts"), "value", "event_type")
    parts = [seen.where(F.col("event_type") != "purchase"), seen.where(F.col("event_type") == "purchase")]
    latest = [merge.latest_per_key(p.drop("event_type"), ["user_id"], ["event_ts", "event_id"]) for p in parts]
    now = as_timestamp(EVENT_AS_OF)
    stored, late = (merge.stamp(p, f"STREAM_{i}", now) for i, p in enumerate(latest))
    return merge.upsert(stored, late, ["user_id"], newest_by="event_ts").drop(*merge.AUDIT)


@case(
    "u2_append_absent",
    f"""SELECT b.customer_id, b.customer_name, b.login_by_using, cast(b.location_id AS bigint) AS location_id, 'BATCH_2' AS batch_id, TIMESTAMP '{DAYS[1]}' AS created_at, TIMESTAMP '{DAYS[1]}' AS updated_at
      FROM {sql_batch(1)} b WHERE NOT EXISTS (SELECT 1 FROM {sql_batch(0)} a WHERE a.customer_id = b.customer_id)""",
)
def _(t):
    return merge.append_absent(stamped(t, 0), stamped(t, 1), KEYS)


@case("u3_row_hash", "SELECT customer_id, sha256(concat_ws('|', customer_id, customer_name, login_by_using, cast(location_id AS varchar))) AS row_hash FROM dim_customer")
def _(t):
    return t["dim_customer"].select("customer_id", row_hash(TRACKED).alias("row_hash"))


def opened(t, number):
    return scd2.new_versions(
        batches(t)[number].withColumn("row_hash", row_hash(TRACKED)).withColumn("scd_action", F.lit("INSERT")),
        batch_id=f"BATCH_{number + 1}", now=as_timestamp(DAYS[number]),
    )


@case(
    "u4_change_detect",
    f"""SELECT b.customer_id, b.login_by_using, CASE WHEN a.customer_id IS NULL THEN 'INSERT' WHEN a.login_by_using <> b.login_by_using THEN 'UPDATE' ELSE 'UNCHANGED' END AS scd_action
      FROM dim_customer_changed b LEFT JOIN {sql_batch(0)} a ON a.customer_id = b.customer_id""".replace(
        "dim_customer_changed",
        "(SELECT customer_id, CASE WHEN location_id < 5 THEN concat(login_by_using, '_NEW') ELSE login_by_using END AS login_by_using FROM dim_customer)",
    ),
)
def _(t):
    changed = F.when(F.col("location_id") < 5, F.concat(segment(), F.lit("_NEW"))).otherwise(segment())
    batch = t["dim_customer"].select(*TRACKED).withColumn("login_by_using", changed)
    return scd2.detect_changes(opened(t, 0), batch, KEYS, TRACKED).select("customer_id", "login_by_using", "scd_action")


def versions(t):
    """All versions after the four batches; each step is written, as the layer tables do."""
    active, expired = opened(t, 0), None
    for number in (1, 2, 3):
        batch = batches(t)[number]
        staged = scd2.detect_changes(active, batch, KEYS, TRACKED)
        after = scd2.apply_changes(active, staged, KEYS, batch_id=f"BATCH_{number + 1}", now=as_timestamp(DAYS[number]))
        after = materialize(after, "versions")
        gone = after.where(F.col("status") == "INACTIVE")
        expired = gone if expired is None else expired.unionByName(gone)
        active = after.where(F.col("status") == "ACTIVE")
    return active.unionByName(expired)


END = scd2.OPEN_END
VERSIONS_SQL = f"""
WITH v1 AS (SELECT * FROM {sql_batch(0)}), v2 AS (SELECT * FROM {sql_batch(1)}), v3 AS (SELECT * FROM {sql_batch(3)}),
raw AS (
  SELECT *, 'BATCH_1' AS batch_id, TIMESTAMP '{DAYS[0]}' AS eff_start_dt FROM v1
  UNION ALL SELECT *, 'BATCH_2', TIMESTAMP '{DAYS[1]}' FROM v2 UNION ALL SELECT *, 'BATCH_4', TIMESTAMP '{DAYS[3]}' FROM v3),
versions AS (
  SELECT *, lead(eff_start_dt) OVER (PARTITION BY customer_id ORDER BY eff_start_dt) AS next_start FROM raw)"""
VERSION_COLUMNS = f"""customer_id, customer_name, login_by_using, cast(location_id AS bigint) AS location_id, CASE WHEN next_start IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
  eff_start_dt, coalesce(next_start, TIMESTAMP '{END}') AS eff_end_dt, batch_id, eff_start_dt AS created_at, coalesce(next_start, eff_start_dt) AS updated_at"""


@case("u6_scd2_full", f"{VERSIONS_SQL} SELECT {VERSION_COLUMNS} FROM versions")
def _(t):
    return versions(t).drop("row_hash")


@case("u5_expired_versions", f"{VERSIONS_SQL} SELECT {VERSION_COLUMNS} FROM versions WHERE next_start IS NOT NULL")
def _(t):
    return versions(t).where(F.col("status") == "INACTIVE").drop("row_hash")


@case("u7_history", f"{VERSIONS_SQL} SELECT {VERSION_COLUMNS}, date_diff('day', eff_start_dt, coalesce(next_start, TIMESTAMP '{END}')) AS version_duration_days FROM versions")
def _(t):
    return scd2.version_history(versions(t).drop("row_hash"), "customer_id")


@case("u8_transitions", "SELECT entity_id, old_status, new_status, status_changed_at FROM status_history")
def _(t):
    return t["status_history"]


@case(
    "u8_seeded_transitions",
    """SELECT user_id, old_status, new_status, status_changed_at FROM (
      SELECT user_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), CASE WHEN user_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN 'view' END) AS old_status,
        event_type AS new_status, ts AS status_changed_at FROM events) x WHERE old_status IS NULL OR old_status <> new_status""",
)
def _(t):
    known = t["orders"].where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("user_id"), F.lit("view").alias("event_type"))
    return history.transitions(t["events"], "user_id", "event_type", "ts", ["event_id"], known)


@case(
    "u9_current_state",
    """SELECT user_id, arg_max(event_type, ts) AS current_status, arg_min(event_type, ts) AS initial_status, max(ts) AS status_updated_at FROM events GROUP BY 1""",
)
def _(t):
    return history.current_state(t["events"], "user_id", "event_type", "ts", ["event_id"])


CALENDAR_SQL = f"""
WITH RECURSIVE days AS (
  SELECT cast(min(o_orderdate) AS date) AS d FROM orders UNION ALL SELECT cast(d + INTERVAL '1' DAY AS date) FROM days WHERE d < DATE '{ORDER_AS_OF[:10]}')
SELECT d AS calendar_date, sha1(cast(d AS varchar)) AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month, week(d) AS week, dayofyear(d) AS day_of_year,
  isodow(d) AS day_of_week, day(d) AS day_of_the_month, left(dayname(d), 3) AS day_name FROM days"""


@case("u10_dim_date", CALENDAR_SQL)
def _(t):
    calendar = dims.date_dimension(dims.date_range(t["fact_order"], "order_date", as_timestamp(ORDER_AS_OF)))
    return calendar.drop("dim_date_hk").withColumn("date_key", F.sha1(F.col("calendar_date").cast("string")))
