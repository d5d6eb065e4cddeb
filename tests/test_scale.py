"""What must not grow with the tables: rows sent through the driver, and how often they are derived."""

import re
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import new_dir, plan_of, rows_of, typed
from stayflow.operators.delta import is_small
from stayflow.plans import marts
from stayflow.schemas import TABLE_SCHEMAS
from stayflow.session import require
from stayflow.workload.layers import Layers


def test_only_small_deliveries_go_through_the_driver():
    assert is_small(100_000, 16 << 20)
    assert not is_small(900_000)
    assert not is_small(1_000, 64 << 20)


def orders(spark, folder):
    """Orders and their line items, one row each; a hotel per order."""
    rows = spark.range(1, 400).withColumnRenamed("id", "o_orderkey")
    rows.selectExpr(
        "o_orderkey", "o_orderkey % 7 as o_custkey", "'O' as o_orderstatus", "o_orderkey * 10.5d as o_totalprice",
        "timestamp'1995-01-01' as o_orderdate",
    ).write.parquet(f"{folder}/orders.parquet")
    rows.selectExpr("o_orderkey as l_orderkey", "o_orderkey % 5 as l_suppkey").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_second_delivery_is_read_from_the_first_one_stored(spark):
    layers = Layers(spark, orders(spark, new_dir("tables")))
    seen = []
    once = layers.once
    layers.once = lambda name, build: once(name, lambda: seen.append((name, plan_of(build()))) or build())
    second = layers.raw("bookings", 2)
    assert [name for name, _ in seen] == ["raw_bookings-1", "raw_bookings-2"]
    assert not re.search(r"(orders|lineitem)\.parquet", dict(seen)["raw_bookings-2"])
    late = second.where(F.col("totalamount").endswith(".25")).count()
    assert late == 7 and second.where("cast(bookingid as int) > 399").count() == 6


def test_tasks_take_in_what_fits_their_memory(spark):
    folder, at_least = new_dir("keys"), "spark.sql.files.minPartitionNum"
    rows = spark.range(3_000_000).selectExpr("cast(id * 7919 as decimal(38,0)) as k", "xxhash64(id) as v")
    rows.coalesce(1).write.mode("overwrite").option("compression", "none").parquet(folder)
    spark.conf.set(at_least, "1")  # no more tasks than the size of the one file asks for
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        assert spark.read.parquet(folder).rdd.getNumPartitions() == 1
        require(spark)
        assert spark.read.parquet(folder).rdd.getNumPartitions() >= 4
    finally:
        spark.conf.unset(at_least)
        require(spark)


def test_marts_by_hotel_do_not_group_by_month(spark):
    bookings = typed(
        spark,
        [(k, 1, k % 2, date(2024, 1 + k % 3, 1), date(2024, 5, 1), Decimal(k), 2, k % 2 == 0, None, None) for k in range(1, 9)],
        TABLE_SCHEMAS["fact_bookings"],
    )
    hotels = typed(spark, [(0, "a", "x", 3, 9, None), (1, "b", "y", 4, 9, None)], TABLE_SCHEMAS["dim_hotels"])
    by_hotel = marts.bookings_by_hotel(bookings)
    by_month = marts.months_by_hotel(marts.bookings_by_month(bookings))
    assert rows_of(by_hotel) == rows_of(by_month) and by_hotel.count() == 2
    reviews = spark.createDataFrame([], TABLE_SCHEMAS["fact_reviews"])
    staff = spark.createDataFrame([], TABLE_SCHEMAS["dim_staff"])
    assert "month" not in plan_of(marts.mart_hotel_performance(hotels, bookings, reviews, staff))
    rates = spark.createDataFrame([], TABLE_SCHEMAS["dim_room_rates"])
    assert "month" not in plan_of(marts.mart_occupancy(bookings, hotels, rates))
