"""Calendar dimension and location enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.buckets import iso_weekday

# Public codes of the states and union territories of India.
STATE_CODES = {
    "ANDHRA PRADESH": "AP",
    "ARUNACHAL PRADESH": "AR",
    "ASSAM": "AS",
    "BIHAR": "BR",
    "CHHATTISGARH": "CG",
    "GOA": "GA",
    "GUJARAT": "GJ",
    "HARYANA": "HR",
    "HIMACHAL PRADESH": "HP",
    "JHARKHAND": "JH",
    "KARNATAKA": "KA",
    "KERALA": "KL",
    "MADHYA PRADESH": "MP",
    "MAHARASHTRA": "MH",
    "MANIPUR": "MN",
    "MEGHALAYA": "ML",
    "MIZORAM": "MZ",
    "NAGALAND": "NL",
    "ODISHA": "OD",
    "PUNJAB": "PB",
    "RAJASTHAN": "RJ",
    "SIKKIM": "SK",
    "TAMIL NADU": "TN",
    "TELANGANA": "TS",
    "TRIPURA": "TR",
    "UTTAR PRADESH": "UP",
    "UTTARAKHAND": "UK",
    "WEST BENGAL": "WB",
}
UNION_TERRITORY_CODES = {
    "ANDAMAN AND NICOBAR ISLANDS": "AN",
    "CHANDIGARH": "CH",
    "DADRA AND NAGAR HAVELI AND DAMAN AND DIU": "DH",
    "DELHI": "DL",
    "JAMMU AND KASHMIR": "JK",
    "LADAKH": "LA",
    "LAKSHADWEEP": "LD",
    "PUDUCHERRY": "PY",
}
# Capitals and city tiers.
CAPITAL_CITIES = [
    "AGARTALA", "AIZAWL", "AMARAVATI", "BANGALORE", "BHOPAL", "BHUBANESWAR", "CHANDIGARH", "CHENNAI",
    "DEHRADUN", "DELHI", "DISPUR", "GANDHINAGAR", "GANGTOK", "HYDERABAD", "IMPHAL", "ITANAGAR", "JAIPUR",
    "KOHIMA", "KOLKATA", "LUCKNOW", "MUMBAI", "PANAJI", "PATNA", "RAIPUR", "RANCHI", "SHILLONG", "SHIMLA",
    "THIRUVANANTHAPURAM",
]
TIER1_CITIES = ["AHMEDABAD", "BANGALORE", "CHENNAI", "DELHI", "HYDERABAD", "KOLKATA", "MUMBAI", "PUNE"]
TIER2_CITIES = [
    "AMRITSAR", "BHOPAL", "BHUBANESWAR", "COIMBATORE", "DEHRADUN", "GUWAHATI", "INDORE", "JAIPUR", "KANPUR",
    "KOCHI", "LUCKNOW", "LUDHIANA", "MADURAI", "MYSORE", "NAGPUR", "PATNA", "RAIPUR", "RANCHI", "SURAT",
    "THANE", "VADODARA", "VARANASI", "VIJAYAWADA", "VISAKHAPATNAM",
]


def calendar_columns(day: Column) -> list[Column]:
    """Calendar attributes as functions of the date; marts use them without a join."""
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.dayofyear(day).alias("day_of_year"),
        iso_weekday(day).alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_the_month"),
        F.dayname(day).alias("day_name"),
    ]


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day of the inclusive range in ``bounds`` (one row: first_day, last_day)."""
    day = F.col("calendar_date")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("calendar_date"))
    return days.select(
        F.xxhash64(F.sha1(day.cast("string"))).alias("dim_date_hk"), day, *calendar_columns(day)
    )


def date_range(fact: DataFrame, column: str, last_day: Column) -> DataFrame:
    return fact.agg(F.to_date(F.min(column)).alias("first_day")).withColumn("last_day", F.to_date(last_day))


def state_lookup(spark: SparkSession) -> DataFrame:
    rows = [(name, code, False) for name, code in STATE_CODES.items()]
    rows += [(name, code, True) for name, code in UNION_TERRITORY_CODES.items()]
    return spark.createDataFrame(rows, "_state string, state_code string, is_union_territory boolean")


def enrich_location(df: DataFrame, city: str = "city", state: str = "state") -> DataFrame:
    """Add state code, union-territory flag, capital flag and city tier.

    The lookup has a fixed 36 rows, so the broadcast has a fixed size.
    """
    place = F.upper(F.trim(F.col(city)))
    codes = F.broadcast(state_lookup(df.sparkSession))
    return (
        df.join(codes, F.upper(F.trim(F.col(state))) == F.col("_state"), "left")
        .drop("_state")
        .withColumn("is_union_territory", F.coalesce("is_union_territory", F.lit(False)))
        .withColumn("capital_city_flag", F.coalesce(place.isin(CAPITAL_CITIES), F.lit(False)))
        .withColumn(
            "city_tier",
            F.when(place.isin(TIER1_CITIES), "TIER1").when(place.isin(TIER2_CITIES), "TIER2").otherwise("TIER3"),
        )
    )


def city_grain(locations: DataFrame) -> DataFrame:
    """One row per city, so that a join on the city name does not multiply facts."""
    return locations.groupBy("city").agg(
        F.min(F.struct("state", "city_tier")).alias("_place")
    ).select("city", "_place.state", "_place.city_tier")
