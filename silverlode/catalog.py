"""The built-in food-delivery configuration."""

from __future__ import annotations

from silverlode.config import Catalog, Column, FileFormat, Retry, Rule, Sla, Source, Target

CSV_COMMA = FileFormat()
CSV_PIPE = FileFormat(delimiter="|", null_tokens=("NULL", "null", ""), trim=True, ragged=True)
JSON_ARRAY = FileFormat(kind="JSON", null_tokens=("NULL", "null"))
PARQUET = FileFormat(kind="PARQUET")

# Columns of each entity in file order, as "name rule [tag]".  The first one is the key.
ENTITY_COLUMNS = {
    "order": """
        order_id raw
        customer_id trim
        restaurant_id int
        order_date timestamp
        total_amount decimal(10,2)
        order_status code
        payment_method trim
    """,
    "delivery": """
        delivery_id raw
        order_id trim
        delivery_agent_id int
        delivery_status code
        estimated_time trim
        customer_address_id int
        delivery_date timestamp
    """,
    "order_item": """
        order_item_id raw
        order_id trim
        menu_id int
        quantity decimal(10,2)
        price decimal(10,2)
        subtotal decimal(10,2)
        order_timestamp timestamp
    """,
    "restaurant": """
        restaurant_id int
        fssai_registration_no int
        restaurant_name trim
        cuisine_type trim
        pricing_for_two int
        restaurant_phone trim PHONE
        operating_hours trim
        location_id int
        active_flag upper
        open_status upper
        locality trim
        restaurant_address trim
        latitude decimal(9,6)
        longitude decimal(9,6)
    """,
    "customer": """
        customer_id raw
        customer_name trim
        mobile trim PII
        email lower EMAIL
        login_by_using trim
        gender upper PII
        dob date PII
        anniversary date
        preferences json
    """,
    "customer_address": """
        customer_address_id int
        customer_id int
        flat_no int
        house_no int
        floor_no int
        building trim
        landmark trim
        locality trim
        city upper
        state upper
        zipcode int
        coordinates trim
        primaryflag upper
        addresstype upper
    """,
    "menu": """
        menu_id int
        restaurant_id int
        item_name trim
        description trim
        price decimal(10,2)
        category upper
        availability upper
        item_type upper
    """,
    "delivery_agent": """
        delivery_agent_id int
        delivery_agent_name trim
        phone int
        vehicle_type upper
        location_id int
        is_active upper
        gender upper
        rating decimal(2,1)
    """,
    "location": """
        location_id int
        city trim
        state trim
        zip_code trim
    """,
}

# Columns that Silver adds to an entity.
DERIVED = {"location": ("state_code", "is_union_territory", "capital_city_flag", "city_tier")}

# Accepted states, after upper-casing and replacing blanks by underscores.
ORDER_STATES = [
    "OUT_FOR_DELIVERY", "COMPLETED", "CANCELLED", "PREPARING", "CONFIRMED", "DELIVERED", "PLACED", "READY", "PENDING",
]
DELIVERY_STATES = ["ASSIGNED", "PICKED_UP", "IN_TRANSIT", "DELIVERED", "FAILED", "CANCELLED", "PENDING", "NEARBY"]
PAYMENT_METHODS = ["WALLET", "CASH", "UPI", "DEBIT CARD", "CREDIT CARD"]


def _columns(entity: str) -> tuple[Column, ...]:
    out = []
    for position, line in enumerate(ENTITY_COLUMNS[entity].split("\n")[1:-1]):
        name, rule, *tag = line.split()
        out.append(Column(name, rule, key=position == 0, tag=tag[0] if tag else None))
    return tuple(out)


def tags(entity: str) -> dict[str, str]:
    return {c.name: c.tag for c in _columns(entity) if c.tag}


def _target(entity: str) -> Target:
    fact = entity in ("order", "delivery", "order_item")
    return Target(f"{entity}_brz", f"{entity}_load_error", f"{entity}_slv", f"{'fact' if fact else 'dim'}_{entity}")


def _sources() -> dict[str, Source]:
    """Two sources per entity: files named after it, and its event stream."""
    out = {}
    number = 101
    for entity in ENTITY_COLUMNS:
        for ingestion in ("BATCH", "STREAM"):
            name = f"{entity.upper()}_{ingestion}"
            batch = ingestion == "BATCH"
            out[name] = Source(
                number, name, entity, ingestion, _columns(entity), _target(entity),
                landing=entity if batch else f"{entity}_events", pattern=f"{entity}_*.csv" if batch else None,
                derived=DERIVED.get(entity, ()),
            )
            number += 1
    return out


def mandatory(entity: str, column: str, text: bool = False) -> Rule:
    good = f"{column} IS NOT NULL" + (f" AND trim({column}) <> ''" if text else "")
    return Rule(f"{entity}_mandatory_{column}", "MANDATORY_CHECK", column, good, f"{column.upper()} is mandatory")


def value(entity: str, column: str, good: str, message: str, name: str = "", active: bool = True) -> Rule:
    return Rule(f"{entity}_value_{name or column}", "VALUE_CHECK", column, good, f"{column.upper()} {message}", active)


def lookup(entity: str, column: str, table: str, active: bool = False) -> Rule:
    return Rule(
        f"{entity}_lookup_{column}", "LOOKUP_CHECK", column, None,
        f"{column.upper()} does not exist in reference table", active, (table, column),
    )


def duplicate(entity: str, column: str) -> Rule:
    return Rule(f"{entity}_duplicate_{column}", "DUPLICATE_ALLOW_ONE_CHECK", column, None, f"Duplicate {column.upper()} found")


def _listed(column: str, values: list[str], blanks: str = "_") -> str:
    names = ", ".join(f"'{v}'" for v in values)
    return f"replace(upper(trim({column})), ' ', '{blanks}') IN ({names})"


def _is(column: str, kind: str) -> str:
    return f"try_cast({column} AS {kind}) IS NOT NULL"


_INT, _NUM = "is not a valid integer", "is not a valid number"


def _rules() -> dict[str, list[Rule]]:
    o, d, i = "order", "delivery", "order_item"
    amount = "decimal(10,2)"
    return {
        o: [
            mandatory(o, "order_id", True), mandatory(o, "customer_id", True), mandatory(o, "restaurant_id"),
            mandatory(o, "order_date"), mandatory(o, "total_amount"), mandatory(o, "order_status", True),
            mandatory(o, "payment_method", True),
            value(o, "restaurant_id", _is("restaurant_id", "bigint"), _INT),
            value(o, "total_amount", _is("total_amount", amount), _NUM),
            value(o, "order_status", _listed("order_status", ORDER_STATES), "is not valid"),
            value(o, "payment_method", _listed("payment_method", PAYMENT_METHODS, " "), "is not valid", active=False),
            lookup(o, "customer_id", "fact_order"), lookup(o, "restaurant_id", "fact_order"),
            duplicate(o, "order_id"),
        ],
        d: [
            mandatory(d, "delivery_id", True), mandatory(d, "order_id", True), mandatory(d, "delivery_agent_id"),
            mandatory(d, "delivery_status", True), mandatory(d, "customer_address_id"), mandatory(d, "delivery_date"),
            value(d, "delivery_agent_id", _is("delivery_agent_id", "bigint"), _INT),
            value(d, "customer_address_id", _is("customer_address_id", "bigint"), _INT),
            value(d, "delivery_status", _listed("delivery_status", DELIVERY_STATES), "is not valid"),
            value(d, "delivery_date", _is("delivery_date", "timestamp"), "is not a valid timestamp"),
            lookup(d, "order_id", "order_brz"), lookup(d, "delivery_agent_id", "dim_delivery_agent"),
            duplicate(d, "delivery_id"),
        ],
        i: [
            mandatory(i, "order_item_id", True), mandatory(i, "order_id", True), mandatory(i, "menu_id"),
            mandatory(i, "quantity"), mandatory(i, "price"), mandatory(i, "subtotal"),
            value(i, "menu_id", _is("menu_id", "bigint"), _INT),
            value(i, "quantity", f"{_is('quantity', amount)} AND try_cast(quantity AS {amount}) > 0", "is not a valid positive number"),
            value(i, "price", f"{_is('price', amount)} AND try_cast(price AS {amount}) >= 0", "is not a valid non-negative number"),
            value(i, "subtotal", f"{_is('subtotal', amount)} AND try_cast(subtotal AS {amount}) >= 0", "is not a valid non-negative number"),
            value(i, "order_timestamp", _is("order_timestamp", "date"), "is not a valid date"),
            value(
                i, "subtotal",
                f"abs(try_cast(subtotal AS {amount}) - try_cast(quantity AS {amount}) * try_cast(price AS {amount})) < 0.01",
                "does not match QUANTITY * PRICE", "subtotal_calc",
            ),
            lookup(i, "order_id", "order_brz"), lookup(i, "menu_id", "dim_menu"),
            duplicate(i, "order_item_id"),
        ],
    }


# Service levels and retry policy.
SLAS = [
    Sla("CUSTOMER_PIPELINE", "LATENCY", "300", ">", "SECONDS", "WARNING"),
    Sla("CUSTOMER_PIPELINE", "LATENCY", "600", ">", "SECONDS", "CRITICAL"),
    Sla("CUSTOMER_PIPELINE", "QUALITY", "95", "<", "PERCENTAGE", "WARNING"),
    Sla("ORDER_PIPELINE_STREAM", "LATENCY", "30", ">", "SECONDS", "CRITICAL"),
    Sla("ALL", "AVAILABILITY", "99", "<", "PERCENTAGE", "CRITICAL"),
]
RETRIES = [
    Retry("ALL", "TECHNICAL", 5, 300),
    Retry("ALL", "TRANSFORMATION", 3, 600),
    Retry("ALL", "VALIDATION", 0, 0),
    Retry("ALL", "REFERENTIAL", 3, 900),
]

DEFAULT = Catalog(_sources(), _rules())
