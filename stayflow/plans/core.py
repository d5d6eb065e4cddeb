"""Dimensions and facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.operators.lookup import lookup_current_sk
from stayflow.operators.merge import merge_actions
from stayflow.operators.scd2 import Versioned, scd2_apply

# Tables, keys, and the columns whose change makes a new version.
CUSTOMERS = Versioned(
    "dim_customers", "customer_id", "customer_sk", ("customer_name", "email", "phone", "city")
)
STAFF = Versioned("dim_staff", "staff_id", "staff_sk", ("role", "shift"), ("hotel_id", "staff_name"))
ROOM_RATES = Versioned(
    "dim_room_rates",
    "room_rate_id",
    "room_rate_sk",
    ("price", "discounted_price", "is_available"),
    ("hotel_id", "room_type"),
)
VERSIONED = {"customers": CUSTOMERS, "staff": STAFF, "room_rates": ROOM_RATES}


@dataclass(frozen=True)
class Merged:
    """A table kept by keyed merge: ``compare`` decides whether a matched row changed,
    ``update`` is what it then takes over, and the stamps are set to the run's timestamp."""

    table: str
    key: str
    compare: tuple[str, ...]
    update: tuple[str, ...]
    update_stamp: str
    insert_stamp: str

    def merge(self, target: DataFrame, source: DataFrame, ts: Column, small: bool = False) -> DataFrame:
        """Target after the merge, with the ``_action`` column. ``small``: the source is
        counted to be small."""
        return merge_actions(
            target,
            source,
            [self.key],
            self.compare,
            self.update,
            {self.update_stamp: ts},
            {self.insert_stamp: ts},
            small,
        )


# Columns compared and taken over by the merges, and their time stamps.
_HOTEL_COLUMNS = ("hotel_name", "city", "stars", "rooms")
HOTELS = Merged("dim_hotels", "hotel_id", _HOTEL_COLUMNS, _HOTEL_COLUMNS, "_loaded_at", "_loaded_at")
# A booking that changes in other columns only is not updated, and the customer version found
# when the booking first arrived is never revised.
BOOKINGS = Merged(
    "fact_bookings",
    "booking_id",
    ("total_amount", "is_high_value"),
    ("total_amount", "is_high_value"),
    "updated_at",
    "created_at",
)
REVIEWS = Merged(
    "fact_reviews", "review_id", ("rating", "sentiment"), ("rating", "sentiment"), "updated_at", "created_at"
)


def booking_source(stg: DataFrame, dim_customers: DataFrame, small: bool = False) -> DataFrame:
    """Staged bookings in fact shape, pointing at the customer version current at load."""
    keyed = lookup_current_sk(stg, dim_customers, CUSTOMERS.key, CUSTOMERS.sk, "booking_id", small)
    return keyed.select(
        "booking_id",
        "customer_sk",
        "hotel_id",
        F.col("checkin_date").cast("date").alias("checkin_date"),
        F.col("checkout_date").cast("date").alias("checkout_date"),
        F.col("total_amount").cast("decimal(12,2)").alias("total_amount"),
        "stay_duration",
        "is_high_value",
    )


def review_source(stg: DataFrame, dim_customers: DataFrame, small: bool = False) -> DataFrame:
    keyed = lookup_current_sk(stg, dim_customers, CUSTOMERS.key, CUSTOMERS.sk, "review_id", small)
    return keyed.select("review_id", "booking_id", "customer_sk", "rating", "comments", "sentiment")


def load_dim_hotels(dim: DataFrame, stg: DataFrame, ts: Column) -> DataFrame:
    source = stg.select("hotel_id", *_HOTEL_COLUMNS)
    return HOTELS.merge(dim, source, ts).drop("_action")


def load_versioned(
    feed: str, dim: DataFrame, stg: DataFrame, ts: Column, last: int, work_path: str
) -> DataFrame:
    return scd2_apply(dim, stg, VERSIONED[feed], ts, last, work_path)


def load_dim_customers(dim: DataFrame, stg: DataFrame, ts: Column, last: int, work_path: str) -> DataFrame:
    return load_versioned("customers", dim, stg, ts, last, work_path)


def load_dim_staff(dim: DataFrame, stg: DataFrame, ts: Column, last: int, work_path: str) -> DataFrame:
    return load_versioned("staff", dim, stg, ts, last, work_path)


def load_dim_room_rates(dim: DataFrame, stg: DataFrame, ts: Column, last: int, work_path: str) -> DataFrame:
    return load_versioned("room_rates", dim, stg, ts, last, work_path)


def load_fact_bookings(fact: DataFrame, stg: DataFrame, dim_customers: DataFrame, ts: Column) -> DataFrame:
    return BOOKINGS.merge(fact, booking_source(stg, dim_customers), ts).drop("_action")


def load_fact_reviews(fact: DataFrame, stg: DataFrame, dim_customers: DataFrame, ts: Column) -> DataFrame:
    return REVIEWS.merge(fact, review_source(stg, dim_customers), ts).drop("_action")
