"""Declared schemas of the raw, staging, core and mart layers.

Schemas are never inferred: raw columns are all text, every later layer is typed by
explicit casts and checked against these definitions before it is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(22,2)": T.DecimalType(22, 2),
    "decimal(38,0)": T.DecimalType(38, 0),
}
# Business keys are whole numbers of up to 38 digits in every layer behind raw.
KEY = "decimal(38,0)"


def _schema(columns: str) -> T.StructType:
    """``"a bigint, b string"`` to a schema. ``StructType.fromDDL`` would need a session at
    import time."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _text(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# The feeds' business columns in file order.
FEED_SCHEMAS = {
    "bookings": _text(
        "bookingid customerid hotelid checkindate checkoutdate totalamount stayduration highvaluebooking"
    ),
    "customers": _text("customerid customername email phone city"),
    "hotels": _text("hotelid hotelname city stars rooms"),
    "staff": _text("staffid hotelid staffname role shift"),
    "reviews": _text("reviewid bookingid customerid rating comments sentiment"),
    "room_rates": _text("roomrateid hotelid roomtype price available discountedprice"),
}

# The raw business key of each feed and the format its files come in.
FEED_KEYS = {
    "bookings": "bookingid",
    "customers": "customerid",
    "hotels": "hotelid",
    "staff": "staffid",
    "reviews": "reviewid",
    "room_rates": "roomrateid",
}
FEED_FORMATS = {
    "bookings": "csv",
    "customers": "csv",
    "hotels": "csv",
    "staff": "csv",
    "reviews": "json",
    "room_rates": "json",
}

# CSV feeds whose free text may hold quoted line breaks; their files are read by one task each.
# Bookings, the largest feed, have no free text, so their files are split.
FEED_MULTI_LINE = {"bookings": False, "customers": True, "hotels": True, "staff": True}

LOAD_METADATA = _schema("_loaded_at timestamp_ntz, _filename string, _batch_id bigint")

RAW_SCHEMAS = {
    feed: T.StructType(cols.fields + LOAD_METADATA.fields) for feed, cols in FEED_SCHEMAS.items()
}

# Input that was delivered damaged, and staged rows whose key is no number.
QUARANTINE_SCHEMA = T.StructType(
    _schema("feed string, reason string, key_text string, record string").fields + LOAD_METADATA.fields
)

# Columns and types of the staging tables.
STG_SCHEMAS = {
    "stg_bookings": _schema(
        f"booking_id {KEY}, customer_id {KEY}, hotel_id {KEY}, checkin_date timestamp_ntz, "
        "checkout_date timestamp_ntz, total_amount decimal(10,2), stay_duration int, "
        "is_high_value boolean, _filename string, _loaded_at timestamp_ntz"
    ),
    "stg_customers": _schema(
        f"customer_id {KEY}, customer_name string, email string, phone string, city string, "
        "_loaded_at timestamp_ntz"
    ),
    "stg_hotels": _schema(
        f"hotel_id {KEY}, hotel_name string, city string, stars int, rooms int, _loaded_at timestamp_ntz"
    ),
    "stg_staff": _schema(
        f"staff_id {KEY}, hotel_id {KEY}, staff_name string, role string, shift string, "
        "_loaded_at timestamp_ntz"
    ),
    "stg_reviews": _schema(
        f"review_id {KEY}, booking_id {KEY}, customer_id {KEY}, rating int, comments string, "
        "sentiment string, _loaded_at timestamp_ntz"
    ),
    "stg_room_rates": _schema(
        f"room_rate_id {KEY}, hotel_id {KEY}, room_type string, price decimal(10,2), "
        "discounted_price decimal(10,2), is_available boolean, _loaded_at timestamp_ntz"
    ),
}

_VERSIONED = "eff_from timestamp_ntz, eff_to timestamp_ntz, is_current boolean, _loaded_at timestamp_ntz"

# Columns and types of the dimensions.
DIM_SCHEMAS = {
    "dim_customers": _schema(
        f"customer_sk bigint, customer_id {KEY}, customer_name string, email string, phone string, "
        f"city string, {_VERSIONED}"
    ),
    "dim_hotels": _schema(
        f"hotel_id {KEY}, hotel_name string, city string, stars int, rooms int, _loaded_at timestamp_ntz"
    ),
    "dim_staff": _schema(
        f"staff_sk bigint, staff_id {KEY}, hotel_id {KEY}, staff_name string, role string, "
        f"shift string, {_VERSIONED}"
    ),
    "dim_room_rates": _schema(
        f"room_rate_sk bigint, room_rate_id {KEY}, hotel_id {KEY}, room_type string, "
        f"price decimal(10,2), discounted_price decimal(10,2), is_available boolean, {_VERSIONED}"
    ),
}

# Columns and types of the facts.
FACT_SCHEMAS = {
    "fact_bookings": _schema(
        f"booking_id {KEY}, customer_sk bigint, hotel_id {KEY}, checkin_date date, checkout_date date, "
        "total_amount decimal(12,2), stay_duration int, is_high_value boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "fact_reviews": _schema(
        f"review_id {KEY}, booking_id {KEY}, customer_sk bigint, rating int, comments string, "
        "sentiment string, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
}

# Columns and types of the marts.
MART_SCHEMAS = {
    "mart_revenue": _schema(
        f"hotel_id {KEY}, hotel_name string, city string, stars int, booking_month date, "
        "total_bookings bigint, total_revenue decimal(22,2), avg_booking_value double, "
        "high_value_count bigint"
    ),
    "mart_occupancy": _schema(
        f"hotel_id {KEY}, hotel_name string, city string, room_type string, total_bookings bigint, "
        "avg_stay_days double, total_room_nights bigint"
    ),
    "mart_customer_segments": _schema(
        f"customer_id {KEY}, customer_name string, city string, total_bookings bigint, "
        "lifetime_value decimal(22,2), avg_spend_per_booking double, last_booking_date date, "
        "customer_tier string"
    ),
    "mart_satisfaction": _schema(
        f"hotel_id {KEY}, hotel_name string, city string, total_reviews bigint, avg_rating double, "
        "positive_count bigint, neutral_count bigint, negative_count bigint, positive_pct double"
    ),
    "mart_staff": _schema(
        f"hotel_id {KEY}, hotel_name string, city string, role string, shift string, staff_count bigint"
    ),
    "mart_hotel_performance": _schema(
        f"hotel_id {KEY}, hotel_name string, city string, stars int, total_revenue decimal(22,2), "
        "total_bookings bigint, avg_booking_value double, high_value_pct double, avg_stay_days double, "
        "avg_rating double, positive_pct double, total_staff bigint"
    ),
}

# What the marts need of the facts, summed up per key range; reviews of bookings not known yet.
PART_SCHEMAS = {
    "part_bookings": _schema(
        f"hotel_id {KEY}, booking_month date, _bookings bigint, _numbered bigint, _priced bigint, "
        "_revenue decimal(22,2), _high bigint, _high_priced bigint, _nights bigint, _stays bigint"
    ),
    "part_reviews": _schema(
        f"hotel_id {KEY}, _reviews bigint, _rated bigint, _rating bigint, _positive bigint, "
        "_rated_positive bigint, _rated_neutral bigint, _rated_negative bigint"
    ),
    "part_waiting": _schema(f"range int, booking_id {KEY}"),
}

TABLE_SCHEMAS = {**PART_SCHEMAS, "rejects": QUARANTINE_SCHEMA, **STG_SCHEMAS, **DIM_SCHEMAS, **FACT_SCHEMAS, **MART_SCHEMAS}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to exactly ``schema``: its columns, their order and their types."""

    def typed(field: T.StructField) -> Column:
        column = F.col(field.name)
        if df.schema[field.name].dataType != field.dataType:
            column = column.cast(field.dataType)
        return column.alias(field.name)

    return df.select(*[typed(f) for f in schema.fields])
