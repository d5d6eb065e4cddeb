"""Feed deltas to cleaned, typed, deduplicated staging tables.

Every load is: unread rows -> usable keys only -> latest row per key -> clean. Only the rows
that survive deduplication are cleaned, and only feed columns travel through its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow import functions as fn
from stayflow.functions.parse import AMOUNT_SENTINELS, PRICE_SENTINELS, RATING_SENTINELS
from stayflow.operators.dedup import latest_by_number, without_key
from stayflow.schemas import FEED_KEYS, FEED_SCHEMAS, QUARANTINE_SCHEMA, STG_SCHEMAS, conform
from stayflow.sources.files import timestamp_literal


def _load(feed: str, raw: DataFrame, ts, columns: dict[str, Column]) -> DataFrame:
    latest = latest_by_number(raw, FEED_KEYS[feed])
    rows = latest.select(
        *[c.alias(name) for name, c in columns.items()], timestamp_literal(ts).alias("_loaded_at")
    )
    return conform(rows, STG_SCHEMAS[f"stg_{feed}"])


# Why a raw row is not staged.
BAD_KEY = "key is no number"


def rejected(feed: str, raw: DataFrame) -> DataFrame:
    """The rows a staging load leaves out, with the reason and all they held."""
    key = FEED_KEYS[feed]
    rows = without_key(raw, key).withColumns(
        {
            "feed": F.lit(feed),
            "reason": F.lit(BAD_KEY),
            "key_text": F.col(key),
            "record": F.to_json(F.struct(*FEED_SCHEMAS[feed].fieldNames())),
        }
    )
    return conform(rows, QUARANTINE_SCHEMA)


def _number(col: str, to: str) -> Column:
    return fn.parse_number(F.col(col), to)


def _money(col: str, sentinels: tuple[str, ...]) -> Column:
    return fn.parse_decimal(fn.null_if_sentinel(F.col(col), sentinels))


def stage_bookings(raw: DataFrame, ts) -> DataFrame:
    return _load(
        "bookings",
        raw,
        ts,
        {
            "booking_id": fn.parse_key(F.col("bookingid")),
            "customer_id": fn.parse_key(F.col("customerid")),
            "hotel_id": fn.parse_key(F.col("hotelid")),
            "checkin_date": fn.parse_ts(F.col("checkindate")),
            "checkout_date": fn.parse_ts(F.col("checkoutdate")),
            "total_amount": _money("totalamount", AMOUNT_SENTINELS),
            "stay_duration": _number("stayduration", "int"),
            "is_high_value": fn.parse_flag(F.col("highvaluebooking")),
            "_filename": F.col("_filename"),
        },
    )


def stage_customers(raw: DataFrame, ts) -> DataFrame:
    return _load(
        "customers",
        raw,
        ts,
        {
            "customer_id": fn.parse_key(F.col("customerid")),
            "customer_name": fn.clean_name(F.col("customername")),
            "email": fn.clean_email(F.col("email")),
            "phone": fn.normalize_phone(F.col("phone")),
            "city": fn.clean_city(F.col("city")),
        },
    )


def stage_hotels(raw: DataFrame, ts) -> DataFrame:
    return _load(
        "hotels",
        raw,
        ts,
        {
            "hotel_id": fn.parse_key(F.col("hotelid")),
            "hotel_name": fn.clean_hotel_name(F.col("hotelname")),
            "city": fn.clean_label(F.col("city")),
            "stars": _number("stars", "int"),
            "rooms": _number("rooms", "int"),
        },
    )


def stage_staff(raw: DataFrame, ts) -> DataFrame:
    return _load(
        "staff",
        raw,
        ts,
        {
            "staff_id": fn.parse_key(F.col("staffid")),
            "hotel_id": fn.parse_key(F.col("hotelid")),
            "staff_name": fn.clean_name(F.col("staffname")),
            "role": fn.clean_label(F.col("role")),
            "shift": fn.clean_shift(F.col("shift")),
        },
    )


def stage_reviews(raw: DataFrame, ts) -> DataFrame:
    return _load(
        "reviews",
        raw,
        ts,
        {
            "review_id": fn.parse_key(F.col("reviewid")),
            "booking_id": fn.parse_key(F.col("bookingid")),
            "customer_id": fn.parse_key(F.col("customerid")),
            "rating": fn.parse_number(fn.null_if_sentinel(F.col("rating"), RATING_SENTINELS), "int"),
            "comments": fn.clean_comments(F.col("comments")),
            "sentiment": fn.clean_sentiment(F.col("sentiment")),
        },
    )


def stage_room_rates(raw: DataFrame, ts) -> DataFrame:
    return _load(
        "room_rates",
        raw,
        ts,
        {
            "room_rate_id": fn.parse_key(F.col("roomrateid")),
            "hotel_id": fn.parse_key(F.col("hotelid")),
            "room_type": fn.clean_label(F.col("roomtype")),
            "price": _money("price", PRICE_SENTINELS),
            "discounted_price": _money("discountedprice", PRICE_SENTINELS),
            "is_available": fn.parse_flag(F.col("available"), "TRUE", "FALSE"),
        },
    )


STAGERS: dict[str, Callable[[DataFrame, object], DataFrame]] = {
    "bookings": stage_bookings,
    "customers": stage_customers,
    "hotels": stage_hotels,
    "staff": stage_staff,
    "reviews": stage_reviews,
    "room_rates": stage_room_rates,
}
