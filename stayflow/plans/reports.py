"""Reporting queries over the hotel performance mart and the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions import measures
from stayflow.functions.measures import count_when, percent, ratio
from stayflow.operators.keys import global_rank


def performance_band(m: DataFrame) -> DataFrame:
    """The mart with each hotel's performance band."""
    return m.withColumn(
        "performance_band", measures.performance_band(F.col("total_revenue"), F.col("avg_rating"))
    )


def band_distribution(m: DataFrame) -> DataFrame:
    """Hotels per band and their share; the window runs over at most five rows."""
    counts = performance_band(m).groupBy("performance_band").agg(F.count(F.lit(1)).alias("hotel_count"))
    total = F.sum("hotel_count").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("hotel_pct", percent(F.col("hotel_count"), total))


def kpi_cards(bookings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Totals of the whole portfolio in one row; the rating is weighted by review."""
    booked = bookings.agg(
        F.sum("total_amount").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_bookings"),
        percent(count_when(F.col("is_high_value")), F.count(F.lit(1))).alias("high_value_pct"),
    )
    rated = reviews.agg(ratio(F.sum("rating"), F.count("rating")).alias("avg_rating"))
    both = booked.unionByName(rated, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def revenue_by_city(m: DataFrame) -> DataFrame:
    """Revenue and bookings per city, highest revenue first."""
    return (
        m.groupBy("city")
        .agg(F.sum("total_revenue").alias("total_revenue"), F.sum("total_bookings").alias("total_bookings"))
        .orderBy(F.col("total_revenue").desc_nulls_last(), "city")
    )


def rating_revenue_points(m: DataFrame) -> DataFrame:
    """A point per hotel for the rating against revenue chart."""
    return performance_band(m).select("hotel_id", "hotel_name", "avg_rating", "total_revenue", "performance_band")


def hotel_ranking(m: DataFrame, work_path: str, k: int | None = None) -> DataFrame:
    """Hotels by revenue. With ``k``, the first ``k`` of them: Spark keeps ``k`` rows per task
    and the rank is worked out on those; without, ranks are computed in parallel."""
    shown = performance_band(m).select(
        "hotel_id", "hotel_name", "city", "stars", "total_revenue", "avg_rating", "performance_band"
    )
    order = [F.col("total_revenue").desc_nulls_last(), F.col("hotel_id")]
    if k is None:
        ranked = global_rank(shown, "total_revenue", "revenue_rank", work_path)
    else:
        by_revenue = Window.partitionBy(F.lit(0)).orderBy(order[0])
        rank = F.rank().over(by_revenue).cast("bigint")
        ranked = shown.orderBy(*order).limit(k).withColumn("revenue_rank", rank)
    return ranked.orderBy(*order)


def filter_mart(
    m: DataFrame, cities: Sequence[str] | None = None, stars: Sequence[int] | None = None
) -> DataFrame:
    """The slicers: any of the given cities and any of the given star classes."""
    if cities is not None:
        m = m.where(F.col("city").isin(*cities))
    if stars is not None:
        m = m.where(F.col("stars").isin(*stars))
    return m


def portfolio_average(m: DataFrame) -> DataFrame:
    """Average revenue per hotel, hotels with revenue only."""
    return m.agg(ratio(F.sum("total_revenue"), F.count("total_revenue")).alias("avg_revenue_per_hotel"))
