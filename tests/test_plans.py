"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import new_dir, plan_of, raw_rows
from stayflow.operators.lookup import lookup_current_sk
from stayflow.plans import marts
from stayflow.plans.core import BOOKINGS
from stayflow.plans.staging import STAGERS
from stayflow.schemas import DIM_SCHEMAS, FACT_SCHEMAS, STG_SCHEMAS
from stayflow.sources.changes import read_changes
from stayflow.sources.files import timestamp_literal
from stayflow.sources.store import Store

NOW = "2024-06-01 06:00:00"


@pytest.fixture
def stored(spark):
    """Empty tables on disk: the plan shapes do not depend on the rows."""
    root = new_dir("plans")

    def table(name, schema):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(schema).parquet(f"{root}/{name}")

    schemas = {**DIM_SCHEMAS, **FACT_SCHEMAS, **STG_SCHEMAS}
    return {name: table(name, schema) for name, schema in schemas.items()}


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def assert_scales(plan, global_aggregates=0):
    """No pairing of all rows, no Python per row, and nothing gathered in one task but the
    partial results of the given number of global aggregates."""
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("SinglePartition") == global_aggregates
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("feed", STAGERS)
def test_staging_limits_groups_before_its_one_shuffle(spark, feed):
    raw = raw_rows(spark, feed, [])
    plan = plan_of(STAGERS[feed](raw, "2024-06-01 06:00:00"))
    assert_scales(plan)
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
    assert "WindowGroupLimit" in plan and plan.index("Partial") > 0


def test_change_feed_prunes_read_batches(spark):
    store = Store(spark, new_dir("store"))
    store.append_raw("hotels", raw_rows(spark, "hotels", [(1, "a", "b", 1, 1)]))
    plan = plan_of(read_changes(store.read_raw("hotels"), 4, 7))
    assert re.search(r"PartitionFilters: \[.*_batch_id.*> 4.*_batch_id.*<= 7", plan)


def test_marts_never_join_raw_fact_rows(stored, no_broadcast):
    fb, fr = stored["fact_bookings"], stored["fact_reviews"]
    hotels, staff, rates = stored["dim_hotels"], stored["dim_staff"], stored["dim_room_rates"]
    plans = {
        "revenue": marts.mart_revenue(fb, hotels),
        "occupancy": marts.mart_occupancy(fb, hotels, rates),
        "segments": marts.mart_customer_segments(fb, stored["dim_customers"]),
        "satisfaction": marts.mart_satisfaction(fr, fb, hotels),
        "staff": marts.mart_staff(staff, hotels),
        "performance": marts.mart_hotel_performance(hotels, fb, fr, staff),
    }
    for df in plans.values():
        assert_scales(plan_of(df))
    revenue = plan_of(plans["revenue"])
    scan = re.search(r"ReadSchema: (struct<[^>]*total_amount[^>]*>)", revenue).group(1)
    assert "comments" not in scan and "created_at" not in scan and "customer_sk" not in scan
    segments = plan_of(plans["segments"])
    assert "IsNotNull(total_amount)" in segments and "IsNotNull(customer_sk)" in segments


def test_small_merge_does_not_shuffle_the_target(stored):
    source = stored["stg_bookings"].select(
        "booking_id", F.lit(1).cast("bigint").alias("customer_sk"), "hotel_id",
        F.col("checkin_date").cast("date").alias("checkin_date"),
        F.col("checkout_date").cast("date").alias("checkout_date"),
        "total_amount", "stay_duration", "is_high_value",
    )
    small = plan_of(BOOKINGS.merge(stored["fact_bookings"], source, timestamp_literal(NOW), small=True))
    large = plan_of(BOOKINGS.merge(stored["fact_bookings"], source, timestamp_literal(NOW)))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "FullOuter" in large
    assert_scales(small)
    assert_scales(large)


def test_lookup_joins_on_key_and_slot(stored, no_broadcast):
    joined = lookup_current_sk(
        stored["stg_bookings"], stored["dim_customers"], "customer_id", "customer_sk", "booking_id"
    )
    plan = plan_of(joined)
    assert_scales(plan)
    assert re.search(r"hashpartitioning\(customer_id#\d+L?, _slot#\d+", plan)
    assert re.search(r"PushedFilters: \[.*is_current", plan)
