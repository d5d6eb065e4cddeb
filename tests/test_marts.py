import random
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import typed, rows_of
from stayflow.plans import marts, reports
from stayflow.schemas import DIM_SCHEMAS, FACT_SCHEMAS


@pytest.fixture(scope="module")
def core(spark):
    """Random core tables with a hot hotel, NULLs, unknown hotels and unknown customers."""
    rnd = random.Random(7)

    def pick(*values):
        return rnd.choice(values)

    hotels = [(h, f"Hotel {h}", pick("Rome", "Oslo", None), rnd.randint(1, 5), 10, None) for h in range(6)]
    customers = [
        (sk, sk // 2, f"N{sk // 2}", None, None, pick("Rome", "Oslo"), None, None, sk % 2 == 1, None) for sk in range(20)
    ]
    staff = [(i, i, pick(0, 0, 1, 2, None), "n", pick("Chef", "Clerk"), pick("DAY", None), None, None, i % 4 > 0, None)
             for i in range(40)]
    rates = [(i, i, pick(0, 0, 1, 3), pick("Suite", "Twin"), D("10.00"), None, True, None, None, i % 5 > 0, None)
             for i in range(30)]
    bookings = [
        (i, pick(*range(22), None), pick(0, 0, 0, 1, 2, 3, 99, None), pick(date(2024, 1, 31), date(2024, 2, 1), None),
         None, pick(D("100.10"), D("2500.55"), None), pick(1, 2, None), pick(True, False, None), None, None)
        for i in range(400)
    ]
    reviews = [
        (i, pick(3, 3, *range(410)), None, pick(1, 2, 5, None), None, pick("Positive", "positive", "Neutral", "Negative", None),
         None, None)
        for i in range(500)
    ]

    def frame(rows, schema):
        return typed(spark, rows, schema).cache()

    return {
        "hotels": frame(hotels, DIM_SCHEMAS["dim_hotels"]),
        "customers": frame(customers, DIM_SCHEMAS["dim_customers"]),
        "staff": frame(staff, DIM_SCHEMAS["dim_staff"]),
        "rates": frame(rates, DIM_SCHEMAS["dim_room_rates"]),
        "bookings": frame(bookings, FACT_SCHEMAS["fact_bookings"]),
        "reviews": frame(reviews, FACT_SCHEMAS["fact_reviews"]),
    }


def test_revenue_equals_joining_first(core):
    got = marts.mart_revenue(core["bookings"], core["hotels"]).drop("avg_booking_value")
    direct = (
        core["bookings"].where("total_amount is not null").join(core["hotels"], "hotel_id")
        .groupBy("hotel_id", "hotel_name", "city", "stars", F.trunc("checkin_date", "month").alias("booking_month"))
        .agg(
            F.count("*").alias("total_bookings"),
            F.sum("total_amount").alias("total_revenue"),
            F.count_if("is_high_value").alias("high_value_count"),
        )
    )
    assert rows_of(got) == rows_of(direct)


def test_occupancy_equals_the_full_product(core):
    got = marts.mart_occupancy(core["bookings"], core["hotels"], core["rates"])
    direct = (
        core["bookings"].join(core["hotels"], "hotel_id").join(core["rates"].where("is_current"), "hotel_id")
        .groupBy("hotel_id", "hotel_name", core["hotels"]["city"], "room_type")
        .agg(
            F.count("booking_id").alias("total_bookings"),
            F.avg("stay_duration").alias("avg_stay_days"),
            F.sum("stay_duration").alias("total_room_nights"),
        )
    )
    assert rows_of(got) == rows_of(direct)


def test_segments_follow_versions_and_drop_unknown_customers(core):
    got = marts.mart_customer_segments(core["bookings"], core["customers"])
    direct = (
        core["bookings"].where("total_amount is not null").join(core["customers"], "customer_sk")
        .groupBy("customer_id", "customer_name", "city")
        .agg(
            F.count("booking_id").alias("total_bookings"),
            F.sum("total_amount").alias("lifetime_value"),
            F.max("checkin_date").alias("last_booking_date"),
        )
    )
    assert rows_of(got.drop("avg_spend_per_booking", "customer_tier")) == rows_of(direct)
    assert got.select("customer_tier").distinct().count() > 1


def test_satisfaction_leaves_out_unrated_reviews(core):
    got = marts.mart_satisfaction(core["reviews"], core["bookings"], core["hotels"])
    label = F.lower("sentiment")
    direct = (
        core["reviews"].where("rating is not null")
        .join(core["bookings"].select("booking_id", "hotel_id"), "booking_id").join(core["hotels"], "hotel_id")
        .groupBy("hotel_id", "hotel_name", "city")
        .agg(
            F.count("review_id").alias("total_reviews"),
            F.avg("rating").alias("avg_rating"),
            F.count_if(label == "positive").alias("positive_count"),
            F.count_if(label == "neutral").alias("neutral_count"),
            F.count_if(label == "negative").alias("negative_count"),
        )
    )
    assert rows_of(got.drop("positive_pct")) == rows_of(direct)


def test_staff_counts_current_employees(core):
    got = marts.mart_staff(core["staff"], core["hotels"])
    direct = (
        core["staff"].where("is_current").join(core["hotels"], "hotel_id")
        .groupBy("hotel_id", "hotel_name", "city", "role", "shift").agg(F.count("staff_sk").alias("staff_count"))
    )
    assert rows_of(got) == rows_of(direct)


def test_performance_keeps_every_hotel_and_multiplies_nothing(core):
    got = {r.hotel_id: r for r in marts.mart_hotel_performance(
        core["hotels"], core["bookings"], core["reviews"], core["staff"]).collect()}
    assert sorted(got) == list(range(6))
    for hotel, row in got.items():
        mine = core["bookings"].where(F.col("hotel_id") == hotel)
        assert row.total_bookings == mine.count()
        assert row.total_revenue == mine.agg(F.sum("total_amount")).first()[0]
        assert row.total_staff == core["staff"].where((F.col("hotel_id") == hotel) & F.col("is_current")).count()
        rated = core["reviews"].join(mine.select("booking_id"), "booking_id").agg(F.avg("rating")).first()[0]
        assert row.avg_rating == rated
    assert got[5].total_revenue is None and got[5].high_value_pct is None and got[5].total_bookings == 0


def test_reports(spark, core):
    m = marts.mart_hotel_performance(core["hotels"], core["bookings"], core["reviews"], core["staff"])
    bands = reports.band_distribution(m).collect()
    assert sum(r.hotel_count for r in bands) == 6
    assert reports.filter_mart(m, cities=["Oslo"]).where("city <> 'Oslo'").count() == 0
    assert reports.filter_mart(m, stars=[1, 2]).where("stars > 2").count() == 0
    assert rows_of(reports.filter_mart(m)) == rows_of(m)
    cities = [r.total_revenue for r in reports.revenue_by_city(m).collect()]
    assert cities == sorted(cities, key=lambda v: -(v if v is not None else -1))
    cards = reports.kpi_cards(core["bookings"], core["reviews"]).collect()
    assert len(cards) == 1 and cards[0].total_bookings == 400


def test_ranking_top_k_is_the_head_of_the_ranking(core, tmp_path):
    m = marts.mart_hotel_performance(core["hotels"], core["bookings"], core["reviews"], core["staff"])
    whole = reports.hotel_ranking(m, str(tmp_path / "a")).collect()
    top = reports.hotel_ranking(m, str(tmp_path / "b"), k=3).collect()
    assert [tuple(r) for r in whole[:3]] == [tuple(r) for r in top]
