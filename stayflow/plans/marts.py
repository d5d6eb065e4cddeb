"""Aggregate marts, rebuilt whole from the core tables.

Facts are brought to the grain of the join key before they are joined. Partial aggregation
runs ahead of every shuffle, so a hotel, booking or customer holding a large part of all rows
reaches the reducing task as one row per map task, and no join sees the raw fact rows.
Averages are carried as exact sums and counts up to the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.measures import count_when, customer_tier, label_is, percent, ratio
from stayflow.operators.joins import join_preaggregated
from stayflow.schemas import MART_SCHEMAS, conform

HOTEL = ("hotel_id", "hotel_name", "city")


def booking_measures() -> dict[str, Column]:
    priced = F.col("total_amount").isNotNull()
    return {
        "_bookings": F.count(F.lit(1)),
        "_numbered": F.count("booking_id"),
        "_priced": F.count("total_amount"),
        "_revenue": F.sum("total_amount"),
        "_high": count_when(F.col("is_high_value")),
        "_high_priced": count_when(F.col("is_high_value") & priced),
        "_nights": F.sum("stay_duration"),
        "_stays": F.count("stay_duration"),
    }


def bookings_by_month(bookings: DataFrame, *within: Column) -> DataFrame:
    """All booking measures per hotel and check-in month (and whatever else is asked for): the one
    pass over the fact that the revenue, occupancy and performance marts share."""
    return bookings.groupBy(*within, "hotel_id", F.trunc("checkin_date", "month").alias("booking_month")).agg(
        *[m.alias(name) for name, m in booking_measures().items()]
    )


# Measures that a hotel's lifetime figures need.
HOTEL_SUMS = ("_bookings", "_numbered", "_priced", "_revenue", "_high", "_nights", "_stays")


def bookings_by_hotel(bookings: DataFrame) -> DataFrame:
    """Booking measures per hotel straight from the fact, for a mart built on its own: there are many
    times as many months as hotels, and all of them would travel."""
    measures = booking_measures()
    return bookings.groupBy("hotel_id").agg(*[measures[c].alias(c) for c in HOTEL_SUMS])


def summed(parts: DataFrame, *keys: str) -> DataFrame:
    """Partial measures added up; they are sums and counts, so parts of parts add up alike."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns if c.startswith("_")])


def months_by_hotel(monthly: DataFrame) -> DataFrame:
    """``bookings_by_hotel`` from sums per month."""
    return monthly.groupBy("hotel_id").agg(*[F.sum(c).alias(c) for c in HOTEL_SUMS])


def review_measures() -> list[Column]:
    rated = F.col("rating").isNotNull()
    labels = {label: label_is(F.col("sentiment"), label) for label in ("positive", "neutral", "negative")}
    measures = {
        "_reviews": F.count("review_id"),
        "_rated": count_when(rated),
        "_rating": F.sum("rating"),
        "_positive": count_when(labels["positive"]),
        **{f"_rated_{label}": count_when(is_label & rated) for label, is_label in labels.items()},
    }
    return [m.alias(name) for name, m in measures.items()]


def reviews_by_hotel(reviews: DataFrame, bookings: DataFrame) -> DataFrame:
    """All review measures per hotel, by way of the reviewed booking: the one join of the two
    facts, shared by the satisfaction and performance marts."""
    per_booking = reviews.groupBy("booking_id").agg(*review_measures())
    return summed(per_booking.join(bookings.select("booking_id", "hotel_id"), "booking_id"), "hotel_id")


def reviews_by_range(reviews: DataFrame, bookings: DataFrame, within: Column) -> DataFrame:
    """``reviews_by_hotel`` per range of reviews, and a row per range and booking that is not there
    (``waiting``): its reviews count once it arrives."""
    per_booking = reviews.groupBy(within.alias("range"), "booking_id").agg(*review_measures())
    known = bookings.select("booking_id", "hotel_id", F.lit(False).alias("waiting"))
    joined = per_booking.join(known, "booking_id", "left").withColumn("waiting", F.coalesce("waiting", F.lit(True)))
    missing = F.when(F.col("waiting"), F.col("booking_id")).alias("booking_id")
    measures = [c for c in per_booking.columns if c.startswith("_")]
    return summed(joined.select("range", "waiting", "hotel_id", missing, *measures), "range", "waiting", "hotel_id", "booking_id")


def mart_revenue(bookings: DataFrame, hotels: DataFrame) -> DataFrame:
    """Bookings and revenue per hotel and check-in month, amounts known only."""
    return revenue_from(bookings_by_month(bookings), hotels)


def revenue_from(monthly: DataFrame, hotels: DataFrame) -> DataFrame:
    rows = (
        monthly.where("_priced > 0")
        .join(hotels, "hotel_id")
        .withColumns(
            {
                "total_bookings": F.col("_priced"),
                "total_revenue": F.col("_revenue"),
                "avg_booking_value": ratio(F.col("_revenue"), F.col("_priced")),
                "high_value_count": F.col("_high_priced"),
            }
        )
    )
    return conform(rows, MART_SCHEMAS["mart_revenue"])


def mart_occupancy(bookings: DataFrame, hotels: DataFrame, room_rates: DataFrame) -> DataFrame:
    """Bookings and nights per hotel and room type.

    A booking names no room type, so it counts once for every current rate of its hotel.
    That product is never formed: a room type's rates are a factor on the hotel's totals.
    """
    return occupancy_from(bookings_by_hotel(bookings), hotels, room_rates)


def occupancy_from(booked: DataFrame, hotels: DataFrame, room_rates: DataFrame) -> DataFrame:
    rates = (
        room_rates.where("is_current")
        .groupBy("hotel_id", "room_type")
        .agg(F.count(F.lit(1)).alias("_rates"))
    )
    rows = (
        rates.join(booked, "hotel_id")
        .join(hotels, "hotel_id")
        .withColumns(
            {
                "total_bookings": F.col("_numbered") * F.col("_rates"),
                "avg_stay_days": ratio(F.col("_nights"), F.col("_stays")),
                "total_room_nights": F.col("_nights") * F.col("_rates"),
            }
        )
    )
    return conform(rows, MART_SCHEMAS["mart_occupancy"])


def mart_customer_segments(bookings: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime value and tier per customer as named and located at booking time.

    Bookings join the version they were loaded with, so a customer who moved has a row per
    city; bookings of unknown customers are left out.
    """
    per_version = (
        bookings.where("total_amount is not null and customer_sk is not null")
        .groupBy("customer_sk")
        .agg(
            F.count("booking_id").alias("_bookings"),
            F.sum("total_amount").alias("_value"),
            F.max("checkin_date").alias("_last"),
        )
    )
    named = per_version.join(customers.select("customer_sk", "customer_id", "customer_name", "city"), "customer_sk")
    rows = (
        named.groupBy("customer_id", "customer_name", "city")
        .agg(
            F.sum("_bookings").alias("total_bookings"),
            F.sum("_value").alias("lifetime_value"),
            F.max("_last").alias("last_booking_date"),
        )
        .withColumns(
            {
                "avg_spend_per_booking": ratio(F.col("lifetime_value"), F.col("total_bookings")),
                "customer_tier": customer_tier(F.col("lifetime_value")),
            }
        )
    )
    return conform(rows, MART_SCHEMAS["mart_customer_segments"])


def mart_satisfaction(reviews: DataFrame, bookings: DataFrame, hotels: DataFrame) -> DataFrame:
    """Rating and sentiment per hotel; reviews without a rating are left out altogether."""
    return satisfaction_from(reviews_by_hotel(reviews, bookings), hotels)


def satisfaction_from(reviewed: DataFrame, hotels: DataFrame) -> DataFrame:
    rows = (
        reviewed.where("_rated > 0")
        .join(hotels, "hotel_id")
        .select(
            *HOTEL,
            F.col("_rated").alias("total_reviews"),
            ratio(F.col("_rating"), F.col("_rated")).alias("avg_rating"),
            F.col("_rated_positive").alias("positive_count"),
            F.col("_rated_neutral").alias("neutral_count"),
            F.col("_rated_negative").alias("negative_count"),
            percent(F.col("_rated_positive"), F.col("_rated")).alias("positive_pct"),
        )
    )
    return conform(rows, MART_SCHEMAS["mart_satisfaction"])


def mart_staff(staff: DataFrame, hotels: DataFrame) -> DataFrame:
    """Current employees per hotel, role and shift."""
    counts = (
        staff.where("is_current")
        .groupBy("hotel_id", "role", "shift")
        .agg(F.count("staff_sk").alias("staff_count"))
    )
    return conform(counts.join(hotels, "hotel_id"), MART_SCHEMAS["mart_staff"])


def mart_hotel_performance(
    hotels: DataFrame, bookings: DataFrame, reviews: DataFrame, staff: DataFrame
) -> DataFrame:
    """One row per hotel with its lifetime figures; hotels without facts keep their row.

    All bookings and all reviews count; averages are over the values that are known.
    """
    return performance_from(
        hotels, bookings_by_hotel(bookings), reviews_by_hotel(reviews, bookings), staff
    )


def performance_from(
    hotels: DataFrame, booked: DataFrame, reviewed: DataFrame, staff: DataFrame
) -> DataFrame:
    employed = staff.where("is_current").groupBy("hotel_id").agg(F.count("staff_sk").alias("_staff"))
    joined = join_preaggregated(
        hotels, [(booked, "hotel_id"), (reviewed, "hotel_id"), (employed, "hotel_id")]
    )
    rows = joined.select(
        *HOTEL,
        "stars",
        F.col("_revenue").alias("total_revenue"),
        F.coalesce("_bookings", F.lit(0)).alias("total_bookings"),
        ratio(F.col("_revenue"), F.col("_priced")).alias("avg_booking_value"),
        percent(F.col("_high"), F.col("_bookings")).alias("high_value_pct"),
        ratio(F.col("_nights"), F.col("_stays")).alias("avg_stay_days"),
        ratio(F.col("_rating"), F.col("_rated")).alias("avg_rating"),
        percent(F.col("_positive"), F.col("_reviews")).alias("positive_pct"),
        F.coalesce("_staff", F.lit(0)).alias("total_staff"),
    )
    return conform(rows, MART_SCHEMAS["mart_hotel_performance"])
