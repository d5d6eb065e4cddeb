import itertools
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import new_dir, rows_of
from stayflow.operators.scd2 import Versioned, scd2_apply, scd2_expire
from stayflow.schemas import DIM_SCHEMAS
from stayflow.sources.files import timestamp_literal

STAFF = Versioned("dim_staff", "staff_id", "staff_sk", ("role", "shift"), ("hotel_id", "staff_name"))
START = datetime(2024, 6, 1, 6)


def ts(batch):
    return timestamp_literal(START + timedelta(days=batch))


def staff(spark, rows):
    return spark.createDataFrame(rows, "staff_id bigint, hotel_id bigint, staff_name string, role string, shift string")


def deliver(spark, dim, rows, batch, null_safe=True):
    last = dim.agg(F.max("staff_sk")).first()[0] or 0
    return scd2_apply(dim, staff(spark, rows), STAFF, ts(batch), last, new_dir("scd") + "/w", null_safe)


def empty(spark):
    return spark.createDataFrame([], DIM_SCHEMAS["dim_staff"])


def check_invariants(dim):
    rows = dim.collect()
    assert len({r.staff_sk for r in rows}) == len(rows)
    for _, versions in itertools.groupby(sorted(rows, key=lambda r: (r.staff_id, r.eff_from)), lambda r: r.staff_id):
        versions = list(versions)
        assert [v.is_current for v in versions] == [False] * (len(versions) - 1) + [True]
        assert versions[-1].eff_to is None
        for older, newer in itertools.pairwise(versions):
            assert older.eff_from < older.eff_to == newer.eff_from
            assert (older.role, older.shift) != (newer.role, newer.shift)


def test_insert_change_null_change_and_no_change(spark):
    first = deliver(
        spark, empty(spark), [(1, 9, "a", "clerk", "DAY"), (2, 9, "b", None, "DAY"), (3, 9, "c", None, "DAY")], 1
    )
    second = deliver(
        spark,
        first,
        # changed; NULL to value; unchanged with NULL; new
        [(1, 9, "a", "chef", "DAY"), (2, 9, "b", "clerk", "DAY"), (3, 9, "c", None, "DAY"), (4, 9, "d", "chef", None)],
        2,
    )
    check_invariants(second)
    current = {r.staff_id: (r.staff_sk, r.role) for r in second.where("is_current").collect()}
    assert current == {1: (4, "chef"), 2: (5, "clerk"), 3: (3, None), 4: (6, "chef")}
    assert second.count() == 6


def test_carried_columns_alone_open_no_version(spark):
    first = deliver(spark, empty(spark), [(1, 9, "a", "clerk", "DAY")], 1)
    second = deliver(spark, first, [(1, 5, "moved", "clerk", "DAY")], 2)
    assert rows_of(second) == rows_of(first)


def test_members_not_delivered_stay(spark):
    first = deliver(spark, empty(spark), [(1, 9, "a", "clerk", "DAY")], 1)
    assert rows_of(deliver(spark, first, [], 2)) == rows_of(first)


def test_strict_comparison_repeats_rows_with_null(spark):
    first = deliver(spark, empty(spark), [(1, 9, "a", None, "DAY"), (2, 9, "b", "x", "DAY")], 1, null_safe=False)
    second = deliver(spark, first, [(1, 9, "a", None, "DAY"), (2, 9, "b", "x", "DAY")], 2, null_safe=False)
    assert second.where("is_current and staff_id = 1").count() == 2
    assert second.where("staff_id = 2").count() == 1


def test_expire_stamps_only_changed_current_versions(spark):
    first = deliver(spark, empty(spark), [(1, 9, "a", "clerk", "DAY"), (2, 9, "b", "clerk", "DAY")], 1)
    second = deliver(spark, first, [(1, 9, "a", "chef", "DAY")], 2)
    third = scd2_expire(second, staff(spark, [(1, 9, "a", "cook", "DAY"), (2, 9, "b", "clerk", "DAY")]), STAFF, ts(3))
    ends = {r.staff_sk: r.eff_to for r in third.collect()}
    assert ends == {1: START + timedelta(days=2), 2: None, 3: START + timedelta(days=3)}


DELIVERY = st.dictionaries(
    st.integers(0, 5), st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", None])), max_size=6
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(deliveries=st.lists(DELIVERY, min_size=2, max_size=3))
def test_any_deliveries_keep_the_invariants_and_repeating_one_changes_nothing(spark, deliveries):
    dim, members = empty(spark), {}
    for batch, rows in enumerate(deliveries, 1):
        rows = [(k, 1, "n", *v) for k, v in rows.items()]
        members.update({r[0]: r[3:] for r in rows})
        dim = deliver(spark, dim, rows, batch)
    check_invariants(dim)
    assert {r.staff_id: (r.role, r.shift) for r in dim.where("is_current").collect()} == members
    assert rows_of(deliver(spark, dim, rows, 9)) == rows_of(dim)
