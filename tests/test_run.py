from datetime import datetime, timedelta

import pytest

import stayflow.plans.run as run_module
from helpers import new_dir, raw_rows, rows_of, typed
from stayflow.operators import delta
from stayflow.plans.run import read_run_log, run_history, run_pipeline, write_log
from stayflow.schemas import FEED_SCHEMAS, TABLE_SCHEMAS
from stayflow.sources.changes import feeds_ready
from stayflow.sources.store import Store

CORE = ("dim_customers", "dim_hotels", "dim_staff", "dim_room_rates", "fact_bookings", "fact_reviews")
DAY = "2024-01-15 14:00:00"


def first_batch(spark, store):
    feeds = {
        "bookings": [(i, i % 4, i % 3, DAY, "2024-01-17 10:00:00", 100 + i, 2, "yes") for i in range(20)],
        "customers": [(i, f"name {i}", None, "5551234567", "rome") for i in range(4)],
        "hotels": [(i, f"hotel-{i}", "rome", 3, 10) for i in range(3)],
        "staff": [(i, i % 3, f"s{i}", "clerk", "Day-1") for i in range(12)],
        "reviews": [(i, i % 20, i % 4, i % 5 + 1, "ok", "positive") for i in range(30)],
        "room_rates": [(i, i % 3, "suite", "10.5", "true", "nan") for i in range(12)],
    }
    for feed, rows in feeds.items():
        store.append_raw(feed, raw_rows(spark, feed, rows))


def second_batch(spark, store):
    feeds = {
        "customers": [(1, "name 1", None, "5551234567", "paris"), (2, "name 2", None, "5551234567", "rome"),
                      (9, "new", None, None, None)],
        # late amount; only the dates differ; unknown customer
        "bookings": [(7, 3, 1, DAY, DAY, 1000, 2, "yes"), (8, 0, 2, DAY, "2025-01-01 00:00:00", 108, 2, "yes"),
                     (77, 999, 1, DAY, DAY, 50, 2, "no")],
        "reviews": [(3, 3, 3, 1, "changed", "negative"), (4, 4, 0, 5, "only the text", "positive")],
    }
    for feed, rows in feeds.items():
        store.append_raw(feed, raw_rows(spark, feed, rows, batch=2, loaded="2024-06-02 05:00:00"))


def snapshot(store, tables=CORE):
    return {t: rows_of(store.read(t)) for t in tables}


def counts(results):
    return {t: c for r in results for t, c in r.counts.items()}


@pytest.fixture(params=["small delta", "large delta"])
def store(spark, request, monkeypatch):
    if request.param == "large delta":
        monkeypatch.setattr(delta, "SMALL_DELTA_ROWS", -1)
    return Store(spark, new_dir("store"), segment_width=5)


def test_two_batches_an_empty_one_and_a_repeated_delivery(spark, store):
    assert store.read("fact_bookings").schema == TABLE_SCHEMAS["fact_bookings"]
    first_batch(spark, store)
    got = counts(run_pipeline(store, "2024-06-01 06:00:00"))
    assert got["fact_bookings"] == {"inserted": 20, "updated": 0}
    assert got["dim_customers"] == {"inserted": 4, "expired": 0}
    before = store.state()

    second_batch(spark, store)
    got = counts(run_pipeline(store, "2024-06-02 06:00:00"))
    assert got["dim_customers"] == {"inserted": 2, "expired": 1}
    assert got["fact_bookings"] == {"inserted": 1, "updated": 1}
    assert got["fact_reviews"] == {"inserted": 0, "updated": 1}
    facts = {r.booking_id: r for r in store.read("fact_bookings").collect()}
    assert len(facts) == 21
    assert facts[7].updated_at is not None and str(facts[7].total_amount) == "1000.00"
    assert facts[8].updated_at is None and str(facts[8].checkout_date) == "2024-01-17"
    assert facts[77].customer_sk is None
    assert facts[1].customer_sk == 2  # the version current when it was loaded
    reviews = {r.review_id: r for r in store.read("fact_reviews").collect()}
    assert (reviews[3].rating, reviews[3].comments) == (1, "Ok")
    segments = store.read("mart_customer_segments")
    assert segments.where("customer_id = 999").count() == 0

    # Only the key ranges the delta falls into were written again.
    old, new = before.segments["fact_bookings"], store.state().segments["fact_bookings"]
    assert {s for s in new if new[s] != old.get(s)} == {"1", "15"}

    after, marts_after = snapshot(store), snapshot(store, ["mart_hotel_performance", "mart_revenue"])
    got = counts(run_pipeline(store, "2024-06-03 06:00:00"))
    assert all(n == 0 for t in CORE for n in got[t].values())
    assert store.read("stg_bookings").count() == 0
    assert snapshot(store) == after
    assert snapshot(store, marts_after) == marts_after

    for feed in ("customers", "bookings", "reviews"):
        again = store.read_raw(feed).where("_batch_id = 2").selectExpr("* except (_batch_id)", "3L as _batch_id")
        store.append_raw(feed, again)
    run_pipeline(store, "2024-06-04 06:00:00")
    assert snapshot(store) == after


def test_a_failed_run_publishes_nothing_and_is_repeated(spark, monkeypatch):
    store = Store(spark, new_dir("store"))
    first_batch(spark, store)

    def broken(run):
        raise RuntimeError("no space left")

    with monkeypatch.context() as patch:
        patch.setattr(run_module, "load_facts", broken)
        with pytest.raises(RuntimeError):
            run_pipeline(store, "2024-06-01 06:00:00")
    assert store.state().run_id == 0 and store.read("dim_customers").count() == 0
    log = {r.name: (r.state, r.error_message) for r in read_run_log(store).collect()}
    assert log == {
        "load_staging": ("SUCCEEDED", None),
        "load_dimensions": ("SUCCEEDED", None),
        "load_facts": ("FAILED", "no space left"),
    }
    got = counts(run_pipeline(store, "2024-06-01 07:00:00"))
    assert got["fact_bookings"]["inserted"] == 20 and store.state().run_id == 1
    assert store.read("mart_revenue").count() == 3


def test_run_history_is_recent_and_newest_first(spark):
    store = Store(spark, new_dir("store"))
    done = datetime(2024, 6, 3)
    for run_id, ts in enumerate(("2024-06-01 06:00:00", "2024-06-02 05:00:00", "2024-06-02 18:00:00"), 1):
        steps = [(f"step {i}", "SUCCEEDED", done + timedelta(seconds=i), None) for i in range(4)]
        write_log(store.begin(run_id, ts), steps)
    rows = run_history(store, "2024-06-02 19:00:00").collect()
    assert [str(r.scheduled_time)[8:13] for r in rows] == ["02 18"] * 4 + ["02 05"] * 4
    assert [r.name for r in rows[:4]] == ["step 3", "step 2", "step 1", "step 0"]


def test_feeds_ready_follows_offsets(spark):
    store = Store(spark, new_dir("store"))
    raw = {f: store.read_raw(f) for f in FEED_SCHEMAS}
    assert set(feeds_ready(raw, {}).first()) == {False}
    first_batch(spark, store)
    raw = {f: store.read_raw(f) for f in FEED_SCHEMAS}
    ready = feeds_ready(raw, {"hotels": 1}).first()
    assert not ready.hotels_ready
    assert all(ready[f"{f}_ready"] for f in FEED_SCHEMAS if f != "hotels")


def test_replaced_table_is_readable_while_it_is_rewritten(spark):
    store = Store(spark, new_dir("store"))
    hotels = typed(spark, [(1, "Inn", "Rome", 3, 9, None)], TABLE_SCHEMAS["dim_hotels"])
    first = store.begin(1, "2024-06-01 06:00:00")
    first.replace("dim_hotels", hotels)
    first.commit({})
    old = store.read("dim_hotels")
    second = store.begin(2, "2024-06-02 06:00:00")
    second.replace("dim_hotels", old.unionByName(old))
    assert store.read("dim_hotels").count() == 1  # not yet committed
    second.commit({})
    assert store.read("dim_hotels").count() == 2 and old.count() == 1


def test_sparse_keys_share_a_bounded_number_of_segments(spark):
    from stayflow.sources.store import MAX_SEGMENTS, ranges_bitmap, ranges_in, segment_of

    keys = spark.range(20_000).selectExpr("xxhash64(id) as k")
    keys = keys.unionByName(spark.range(500).selectExpr("cast(concat('9', repeat('8', 25), id) as decimal(38,0)) as k"))
    ranges = {str(r.s) for r in keys.select(segment_of("k", 10).alias("s")).distinct().collect()}
    assert len(ranges) <= MAX_SEGMENTS and all(0 <= int(r) < MAX_SEGMENTS for r in ranges)
    assert ranges_in(keys.agg(ranges_bitmap("k", 10)).first()[0]) == ranges


def test_state_stays_small_over_many_runs(spark):
    """Fifty runs that each append a segment, replace a table and move an offset and a mark."""
    from stayflow.sources.store import EPOCH_RUNS, FOLD

    store = Store(spark, new_dir("store"))
    hotels = typed(spark, [(1, "Inn", "Rome", 3, 9, None)], TABLE_SCHEMAS["dim_hotels"])
    versions = typed(
        spark, [(1, 5, "Ann", None, None, "Rome", None, None, False, None)], TABLE_SCHEMAS["dim_customers"]
    ).coalesce(1)
    for run_id in range(1, 51):
        run = store.begin(run_id, "2024-06-01 06:00:00")
        if run_id == 1:
            run.replace("dim_hotels", hotels)
        run.add("dim_customers", versions, "closed")
        run.fold("dim_customers", "closed")
        run.marks["customer_sk"] = run_id
        run.commit({"hotels": run_id} if run_id % 2 else {})
    state = store.state()
    assert (state.run_id, state.offsets, state.marks) == (50, {"hotels": 49}, {"customer_sk": 50})
    assert len(state.segments["dim_customers"]) < 2 * FOLD
    assert store.read("dim_customers").count() == 50 and store.read("dim_hotels").count() == 1
    epoch, records = store._latest_records()
    assert epoch == 50 // EPOCH_RUNS and len({r.run_id for r in records}) <= EPOCH_RUNS
    # An epoch whose first commit left nothing behind is not looked at.
    (spark.range(0).write.mode("overwrite").json(store.path("commits", "epoch=9", "run=90")))
    assert store.state() == state


def test_wide_keys_and_rejected_rows(spark):
    """Keys of up to 38 digits reach the facts; rows without a usable key are kept and counted."""
    store, wide = Store(spark, new_dir("store")), "12345678901234567890"
    widest = "9" * 38
    feeds = {
        "bookings": [(wide, widest, "7", DAY, DAY, 10, 2, "yes"), ("b7", "1", "7", DAY, DAY, 1, 2, "no"),
                     (None, "1", "7", DAY, DAY, 1, 2, "no"), ("9" * 39, "1", "7", DAY, DAY, 1, 2, "no"),
                     (f" 00{wide} ", widest, "7", DAY, DAY, 10, 2, "yes")],
        "customers": [(widest, "ann", None, None, "rome")],
        "hotels": [(7, "inn", "rome", 3, 10)],
        "reviews": [("1.5e2", wide, widest, 4, "ok", "positive"), ("x", wide, widest, 4, "ok", "positive")],
    }
    for feed, rows in feeds.items():
        store.append_raw(feed, raw_rows(spark, feed, rows))
    got = counts(run_pipeline(store, "2024-06-01 06:00:00"))
    assert got["stg_bookings"] == {"staged": 1, "rejected": 3, "damaged": 0}
    assert got["stg_reviews"] == {"staged": 1, "rejected": 1, "damaged": 0}
    assert got["stg_hotels"] == {"staged": 1, "rejected": 0, "damaged": 0}
    (fact,) = store.read("fact_bookings").collect()
    assert (str(fact.booking_id), fact.customer_sk, str(fact.hotel_id)) == (wide, 1, "7")
    (review,) = store.read("fact_reviews").collect()
    assert (str(review.review_id), str(review.booking_id)) == ("150", wide)
    assert str(store.read("dim_customers").first().customer_id) == widest
    assert store.read("mart_satisfaction").first().total_reviews == 1
    rejects = store.read("rejects").orderBy("feed", "key_text").collect()
    assert [(r.feed, r.key_text) for r in rejects] == [
        ("bookings", None), ("bookings", "9" * 39), ("bookings", "b7"), ("reviews", "x")]
    assert {r.reason for r in rejects} == {"key is no number"} and '"hotelid":"7"' in rejects[2].record
    # A second delivery of the same keys finds its rows again.
    store.append_raw("bookings", raw_rows(spark, "bookings", [(wide, widest, "7", DAY, DAY, 99, 2, "yes")], batch=2))
    got = counts(run_pipeline(store, "2024-06-02 06:00:00"))
    assert got["fact_bookings"] == {"inserted": 0, "updated": 1}
    assert got["stg_bookings"]["rejected"] == 0 and store.read("rejects").count() == 4


def test_marts_follow_a_small_delta_by_its_ranges(spark):
    """Partial sums of untouched ranges stay, reviews count once their booking arrives, and the
    marts are those of the whole facts."""
    from stayflow.plans import marts

    store = Store(spark, new_dir("store"), segment_width=5)
    first_batch(spark, store)
    early = [(100, 77, 3, 5, "early", "positive"), (101, None, 3, 5, "of nothing", "positive")]
    store.append_raw("reviews", raw_rows(spark, "reviews", early, batch=2))
    run_pipeline(store, "2024-06-01 06:00:00")
    before = store.state().segments
    assert store.read("part_waiting").collect()[0].booking_id == 77

    store.append_raw("bookings", raw_rows(spark, "bookings", [(77, 3, 1, DAY, DAY, 50, 2, "no"), (7, 3, 1, DAY, DAY, 1000, 2, "yes")], batch=2))
    run_pipeline(store, "2024-06-02 06:00:00")
    after = store.state().segments
    changed = {t: {r for r in after[t] if after[t][r] != before[t].get(r)} for t in ("part_bookings", "part_reviews")}
    assert changed == {"part_bookings": {"1", "15"}, "part_reviews": {"20"}}
    assert store.read("part_waiting").count() == 0
    bookings, reviews, hotels = (store.read(t) for t in ("fact_bookings", "fact_reviews", "dim_hotels"))
    assert rows_of(store.read("mart_satisfaction")) == rows_of(marts.mart_satisfaction(reviews, bookings, hotels))
    assert rows_of(store.read("mart_revenue")) == rows_of(marts.mart_revenue(bookings, hotels))
    staff = store.read("dim_staff")
    whole = marts.mart_hotel_performance(hotels, bookings, reviews, staff)
    assert rows_of(store.read("mart_hotel_performance")) == rows_of(whole)
    assert store.read("mart_satisfaction").where("hotel_id = 1").first().total_reviews == 11

    run_pipeline(store, "2024-06-03 06:00:00")  # nothing new: no partial sum is made again
    last = store.state().segments
    assert all(last[t] == after[t] for t in ("part_bookings", "part_reviews"))
