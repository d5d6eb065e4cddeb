import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import new_dir, plan_of, raw_rows, rows_of
from stayflow.operators.dedup import dedup_latest, latest_by_number, latest_first
from stayflow.operators.delta import small_anti, small_semi
from stayflow.operators.joins import join_preaggregated
from stayflow.operators.keys import assign_keys, global_rank
from stayflow.operators.lookup import hot_keys, lookup_current_sk, unmatched
from stayflow.operators.merge import merge_actions, merge_upsert

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# -- dedup ---------------------------------------------------------------------------


def test_later_load_wins_and_missing_load_time_loses(spark):
    old = raw_rows(spark, "hotels", [(1, "old", "r", 1, 1), (2, "kept", "r", 1, 1)], loaded="2024-01-01 00:00:00")
    new = raw_rows(spark, "hotels", [(1, "new", "r", 1, 1)], loaded="2024-01-02 00:00:00")
    lost = raw_rows(spark, "hotels", [(2, "zzz", "r", 1, 1)]).withColumn(
        "_loaded_at", F.lit(None).cast("timestamp_ntz")
    )
    got = latest_by_number(old.unionByName(new).unionByName(lost), "hotelid")
    assert {r.hotelid: r.hotelname for r in got.collect()} == {"1": "new", "2": "kept"}


def test_spellings_of_one_number_are_one_key_and_bad_keys_go(spark):
    rows = [("1", "a", "r", 1, 1), ("01", "b", "r", 1, 1), (" 1", "c", "r", 1, 1), ("abc", "d", "r", 1, 1),
            ("", "e", "r", 1, 1), (None, "f", "r", 1, 1)]
    raw = raw_rows(spark, "hotels", rows)
    # Equal load times: the key text, the first business column, breaks the tie downwards.
    assert [r.hotelname for r in latest_by_number(raw, "hotelid").collect()] == ["a"]
    by_text = dedup_latest(raw, [F.col("hotelid")], latest_first(raw))
    assert by_text.count() == 6


@FEW
@given(
    rows=st.lists(st.tuples(st.integers(0, 3), st.sampled_from("abc"), st.integers(0, 2)), min_size=1, max_size=25),
    parts=st.integers(1, 5),
)
def test_one_row_per_key_whatever_the_partitioning(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, v string, t int").repartition(parts)
    order = [F.col("t").desc_nulls_last(), F.col("v").desc_nulls_last()]
    got = {r.k: (r.t, r.v) for r in dedup_latest(df, [F.col("k")], order).collect()}
    assert got == {k: max((t, v) for key, v, t in rows if key == k) for k, _, _ in rows}


# -- merge ---------------------------------------------------------------------------

SCHEMA = "k int, a string, b string, made string, changed string"


def _model(target, source):
    out = dict(target)
    for k, (a, b) in source.items():
        if k not in out:
            out[k] = (a, b, "now", None)
        elif out[k][0] != a:
            out[k] = (a, out[k][1], out[k][2], "now")
    return out


@FEW
@given(
    target=st.dictionaries(st.integers(0, 9), st.tuples(st.sampled_from(["x", "y", None]), st.just("old"))),
    source=st.dictionaries(st.integers(0, 9), st.tuples(st.sampled_from(["x", "y", None]), st.just("new"))),
    small=st.booleans(),
)
def test_merge_equals_a_dictionary(spark, target, source, small):
    target = {k: (*v, "then", None) for k, v in target.items()}
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], SCHEMA)
    s = spark.createDataFrame([(k, *v) for k, v in source.items()], "k int, a string, b string")
    now = F.lit("now")
    merged = merge_upsert(
        t, s, ["k"], ["a"], ["a"], {"changed": now}, {"made": now}, small_source=small
    )
    assert {r[0]: tuple(r[1:]) for r in merged.collect()} == _model(target, source)


def test_merge_reports_actions(spark):
    t = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, a string")
    s = spark.createDataFrame([(1, "x"), (2, None), (4, "n")], "k int, a string")
    for small in (True, False):
        got = {r.k: r._action for r in merge_actions(t, s, ["k"], ["a"], ["a"], small_source=small).collect()}
        assert got == {1: "keep", 2: "update", 3: "keep", 4: "insert"}


@pytest.mark.parametrize("small", [True, False])
def test_merge_refuses_duplicate_source_keys(spark, small):
    t = spark.createDataFrame([(1, "x")], "k int, a string")
    s = spark.createDataFrame([(1, "p"), (1, "q")], "k int, a string")
    with pytest.raises(Exception, match="duplicate source key"):
        merge_upsert(t, s, ["k"], ["a"], ["a"], small_source=small).collect()


# -- lookup and anti joins -------------------------------------------------------------


def test_anti_join_strict_and_null_safe(spark):
    dim = spark.createDataFrame([(1, None), (2, "a")], "k int, v string")
    src = spark.createDataFrame([(1, None), (2, "a"), (3, "new")], "k int, v string")
    assert sorted(r.k for r in unmatched(src, dim, ["k", "v"]).collect()) == [1, 3]
    assert [r.k for r in unmatched(src, dim, ["k", "v"], null_safe=True).collect()] == [3]


def test_lookup_with_hot_and_missing_keys_equals_a_plain_join(spark):
    # A third of the rows share one customer, a sixth has none, some are unknown.
    facts = spark.range(30_000).select(
        F.col("id").alias("booking_id"),
        F.expr("case when id % 3 = 0 then 7 when id % 6 = 1 then null else id % 900 end").alias("customer_id"),
    )
    dim = spark.range(600).select(
        F.col("id").alias("customer_id"), (F.col("id") + 5000).alias("customer_sk"), F.lit(True).alias("is_current")
    ).unionByName(
        spark.range(600).select(
            F.col("id").alias("customer_id"), (F.col("id") + 1).alias("customer_sk"), F.lit(False).alias("is_current")
        )
    )
    assert [r.customer_id for r in hot_keys(facts, "customer_id").collect()] == [7]
    plain = facts.join(dim.where("is_current").drop("is_current"), "customer_id", "left")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for small in (False, True):
            got = lookup_current_sk(facts, dim, "customer_id", "customer_sk", "booking_id", small)
            assert got.count() == 30_000
            assert got.select(plain.columns).exceptAll(plain).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_spread_over_tasks(spark):
    facts = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    dim = spark.range(1000).select(F.col("id").alias("k"), F.lit(True).alias("is_current"), F.col("id").alias("sk"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = lookup_current_sk(facts, dim, "k", "sk", "id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 10_000  # unspread, one task would hold 20,000 rows and more


def test_lookup_of_nothing_and_into_nothing(spark):
    facts = spark.createDataFrame([(1, 5), (2, None)], "id bigint, k bigint")
    dim = spark.createDataFrame([(5, 50, True)], "k bigint, sk bigint, is_current boolean")
    assert lookup_current_sk(facts.limit(0), dim, "k", "sk", "id").collect() == []
    assert {r.id: r.sk for r in lookup_current_sk(facts, dim.limit(0), "k", "sk", "id").collect()} == {1: None, 2: None}
    assert {r.id: r.sk for r in lookup_current_sk(facts, dim, "k", "sk", "id").collect()} == {1: 50, 2: None}


def test_small_semi_and_anti_split_a_table(spark):
    large, small = spark.range(100).toDF("k"), spark.createDataFrame([(5,), (5,), (200,)], "k bigint")
    assert [r.k for r in small_semi(large, small, ["k"]).collect()] == [5]
    assert small_anti(large, small, ["k"]).count() == 99


# -- keys and ranks ----------------------------------------------------------------------


def test_keys_are_dense_unique_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5003).alias("k")).repartition(7)
    keyed = assign_keys(df, [F.col("k")], "sk", 100, new_dir("keys") + "/w").collect()
    ordered = sorted(keyed, key=lambda r: r.k)
    assert [r.sk for r in ordered] == list(range(101, 5101))


def test_keys_of_nothing(spark):
    df = spark.createDataFrame([], "k bigint")
    assert assign_keys(df, [F.col("k")], "sk", 5, new_dir("keys") + "/w").collect() == []


@FEW
@given(values=st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=30))
def test_global_rank_equals_sorting(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(4)
    got = {r.id: r.rank for r in global_rank(df, "v", "rank", new_dir("rank") + "/w").collect()}

    def ahead(v):
        return sum(1 for o in values if o is not None and (v is None or o > v))

    assert got == {i: 1 + ahead(v) for i, v in enumerate(values)}


def test_rank_of_a_value_that_fills_many_partitions(spark):
    df = spark.range(4000).selectExpr("id", "case when id % 4 = 0 then null when id % 4 < 3 then 7 else id end as v")
    ranked = global_rank(df.repartition(5), "v", "rank", new_dir("rank") + "/w")
    got = {r.id: r.rank for r in ranked.collect()}
    above = sum(1 for i in range(4000) if i % 4 == 3 and i > 7)
    assert all(got[i] == 1 + above for i in range(4000) if i % 4 in (1, 2))
    assert all(got[i] == 3001 for i in range(0, 4000, 4))
    assert got[3] == 3000 and got[3999] == 1
    plan = plan_of(ranked)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


# -- fan-out -----------------------------------------------------------------------------


def test_preaggregated_join_does_not_multiply(spark):
    hotel = spark.createDataFrame([(1,), (2,)], "hotel_id int")
    bookings = spark.createDataFrame([(1, 100)] * 10, "hotel_id int, amount int")
    reviews = spark.createDataFrame([(1, 5)] * 3, "hotel_id int, rating int")
    staff = spark.createDataFrame([(1,)] * 5, "hotel_id int")
    direct = hotel.join(bookings, "hotel_id").join(reviews, "hotel_id").join(staff, "hotel_id")
    assert direct.count() == 150
    guarded = join_preaggregated(
        hotel,
        [
            (bookings.groupBy("hotel_id").agg(F.sum("amount").alias("revenue")), "hotel_id"),
            (reviews.groupBy("hotel_id").agg(F.avg("rating").alias("rating")), "hotel_id"),
            (staff.groupBy("hotel_id").agg(F.count(F.lit(1)).alias("staff")), "hotel_id"),
        ],
    )
    assert rows_of(guarded) == [
        (1, 5.0, 1000, 5),
        (2, None, None, None),
    ]
