"""One run of the layers: staging, dimensions, facts, marts.

The run takes one timestamp and one upper batch per feed, so everything it writes belongs
together. Nothing is visible before its commit record is written at the very end; a failed
run leaves the previous state in place and is repeated under the same number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stayflow.functions.parse import parse_key
from stayflow.operators.delta import SMALL_DELTA_TASKS, is_small, small_semi
from stayflow.operators.keys import assign_keys_observed
from stayflow.operators.lookup import unmatched
from stayflow.operators.merge import INSERT, UPDATE
from stayflow.operators.scd2 import Versioned, carry_over, close_replaced, open_versions
from stayflow.plans import marts
from stayflow.plans.core import (
    BOOKINGS,
    HOTELS,
    REVIEWS,
    VERSIONED,
    Merged,
    booking_source,
    review_source,
)
from stayflow.plans.staging import STAGERS, rejected
from stayflow.schemas import DIM_SCHEMAS, FEED_KEYS, STG_SCHEMAS
from stayflow.sources.changes import read_changes, unread
from stayflow.sources.files import timestamp_literal
from stayflow.sources.scratch import materialise
from stayflow.sources.store import Run, Staged, Store, ranges_bitmap, ranges_in, segment_of

LOG_SCHEMA = (
    "run_id bigint, name string, state string, scheduled_time timestamp_ntz, "
    "completed_time timestamp_ntz, error_message string"
)
SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"


@dataclass(frozen=True)
class StepResult:
    """What a step did: row counts per table, and the status line saying so."""

    name: str
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    @property
    def message(self) -> str:
        tables = [
            f"{table} " + ", ".join(f"{n} {what}" for what, n in counts.items())
            for table, counts in sorted(self.counts.items())
        ]
        return f"{self.name}: " + ("; ".join(tables) or "nothing to do")


def together(spark: SparkSession, jobs: Sequence[Callable[[], None]]) -> None:
    """Run independent writes side by side, so small tables fill the gaps large ones leave.
    All are awaited; the first failure is raised."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        waiting = [pool.submit(inherit(job)) for job in jobs]
    for job in waiting:
        job.result()


def _count(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df`` counting rows per condition while it is written."""
    return _observe(df, {name: F.count_if(condition) for name, condition in conditions.items()})


def _observe(df: DataFrame, measures: dict[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[m.alias(name) for name, m in measures.items()]), seen


def load_staging(run: Run, high: dict[str, int], no_key: dict[str, int]) -> StepResult:
    """Rows staged per feed, rows whose key is no number (kept in ``rejects``), and records that
    the same batches left in quarantine."""
    counts: dict[str, dict[str, int]] = {}

    def stage(feed: str) -> None:
        table, low = f"stg_{feed}", run.base.offsets.get(feed, 0)
        raw = read_changes(run.store.read_raw(feed), low, high[feed])
        rows = STAGERS[feed](raw, run.batch_ts)
        texts = [F.octet_length(name) for name, kind in rows.dtypes if kind == "string"]
        text_bytes = F.sum(sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0).cast("bigint")))
        key = STG_SCHEMAS[table].fieldNames()[0]
        measures = {
            "staged": F.count(F.lit(1)),
            "text_bytes": text_bytes,
            "ranges": ranges_bitmap(key, run.store.segment_width),
        }
        rows, seen = _observe(rows, measures)
        run.replace(table, rows)
        found = seen.get
        run.staged[table] = Staged(found["staged"], found["text_bytes"] or 0, ranges_in(found["ranges"]))
        if no_key[feed]:
            run.add("rejects", rejected(feed, raw), "run", f"-{feed}")
        damaged = 0
        if run.store.folders("quarantine", feed):
            damaged = read_changes(run.store.read_quarantine(feed), low, high[feed]).count()
        counts[table] = {"staged": found["staged"], "rejected": no_key[feed], "damaged": damaged}

    together(run.store.spark, [lambda f=feed: stage(f) for feed in STAGERS])
    run.fold("rejects", "run")
    return StepResult("load_staging", counts)


def apply_merge(
    run: Run, spec: Merged, staging: str, source: Callable[[DataFrame, bool], DataFrame]
) -> dict[str, int]:
    """Merge a delta into the key ranges it falls into; all other ranges stay as they are."""
    delta = run.staged[staging]
    if not delta.rows:
        return {"inserted": 0, "updated": 0}
    stg, small, touched = run.read(staging), is_small(delta.rows, delta.text_bytes), delta.ranges
    target = run.read_ranges(spec.table, touched)
    merged = spec.merge(target, source(stg, small), timestamp_literal(run.batch_ts), small)
    merged, seen = _count(merged, inserted=F.col("_action") == INSERT, updated=F.col("_action") == UPDATE)
    run.replace_ranges(spec.table, spec.key, touched, merged, in_place=small)
    return dict(seen.get)


def apply_versions(run: Run, spec: Versioned, staging: str) -> dict[str, int]:
    """Open and close versions. Only ranges holding a member that really changed are
    rewritten, and closed versions are added to the history without reading it."""
    delta = run.staged[staging]
    if not delta.rows:
        return {"inserted": 0, "expired": 0}
    width, ts = run.store.segment_width, timestamp_literal(run.batch_ts)
    delivered = run.read(staging)
    current = run.read_current(spec.table, delta.ranges)
    if is_small(delta.rows):
        current = small_semi(current, delivered, [spec.key])
    fresh = unmatched(delivered, current, [spec.key, *spec.tracked], null_safe=True)
    fresh = fresh.select(spec.key, *spec.carried, *spec.tracked)
    last = run.mark(spec.sk)
    measures = {"rows": F.count(F.lit(1)), "ranges": ranges_bitmap(spec.key, width)}
    keyed, seen = assign_keys_observed(
        fresh, [F.col(spec.key)], spec.sk, last, run.work_path(spec.table), measures
    )
    inserted, touched = seen.get["rows"], ranges_in(seen.get["ranges"])
    if not inserted:
        return {"inserted": 0, "expired": 0}
    small = is_small(inserted)
    opened = open_versions(keyed, DIM_SCHEMAS[spec.table].fieldNames(), ts)
    current = run.read_current(spec.table, touched)
    stay = carry_over(current, opened, spec.key, small)
    closed, seen = _count(close_replaced(current, opened, spec.key, ts, small), expired=F.lit(True))
    if small:
        opened = opened.coalesce(SMALL_DELTA_TASKS)
    added: list[str] = []
    together(
        run.store.spark,
        [
            lambda: run.replace_ranges(spec.table, spec.key, touched, stay.unionByName(opened), small),
            lambda: added.append(run.add(spec.table, closed, "closed")),
        ],
    )
    if not seen.get["expired"]:
        run.leave_out(spec.table, added[0])
    run.fold(spec.table, "closed")
    run.marks[spec.sk] = last + inserted
    return {"inserted": inserted, **seen.get}


def load_dimensions(run: Run) -> StepResult:
    counts: dict[str, dict[str, int]] = {}

    def hotels() -> None:
        counts[HOTELS.table] = apply_merge(
            run, HOTELS, "stg_hotels", lambda stg, small: stg.drop("_loaded_at")
        )

    def versioned(feed: str) -> None:
        spec = VERSIONED[feed]
        counts[spec.table] = apply_versions(run, spec, f"stg_{feed}")

    together(run.store.spark, [hotels, *[lambda f=feed: versioned(f) for feed in VERSIONED]])
    return StepResult("load_dimensions", counts)


def load_facts(run: Run) -> StepResult:
    counts: dict[str, dict[str, int]] = {}
    customers = run.read_current("dim_customers")

    def fact(spec: Merged, staging: str, source: Callable[[DataFrame, DataFrame, bool], DataFrame]) -> None:
        counts[spec.table] = apply_merge(run, spec, staging, lambda stg, small: source(stg, customers, small))

    together(
        run.store.spark,
        [
            lambda: fact(BOOKINGS, "stg_bookings", booking_source),
            lambda: fact(REVIEWS, "stg_reviews", review_source),
        ],
    )
    return StepResult("load_facts", counts)


def refresh_parts(run: Run) -> None:
    """What the marts need of the facts, per key range: only the ranges that this run rewrote are
    summed up again, and those with reviews that waited for a booking of this delivery."""
    width = run.store.segment_width

    def outdated(fact: str, part: str) -> set[str]:
        return run.touched.get(fact, set()) | (set(run.segments(fact)) - set(run.segments(part)))

    def bookings() -> None:
        ranges = outdated("fact_bookings", "part_bookings")
        if ranges:
            of_key = segment_of("booking_id", width).alias("range")
            rows = marts.bookings_by_month(run.read_ranges("fact_bookings", ranges), of_key)
            run.replace_parts("part_bookings", ranges, rows, "range")

    def reviews() -> None:
        ranges = outdated("fact_reviews", "part_reviews")
        if run.staged["stg_bookings"].rows:
            arrived = run.read("stg_bookings").select("booking_id")
            waiting = run.read("part_waiting").join(arrived, "booking_id", "left_semi")
            ranges |= {str(r.range) for r in waiting.select("range").distinct().collect()}  # ranges: few
        if not ranges:
            return
        rows = run.read_ranges("fact_reviews", ranges)
        booked = ranges_in(rows.agg(ranges_bitmap("booking_id", width)).first()[0])
        known = run.read_ranges("fact_bookings", booked)
        found = marts.reviews_by_range(rows, known, segment_of("review_id", width))
        found = materialise(found, run.work_path("reviews_by_range"))
        run.replace_parts("part_reviews", ranges, found.where("not waiting"), "range")
        run.replace_parts("part_waiting", ranges, found.where("waiting and booking_id is not null"), "range")

    together(run.store.spark, [bookings, reviews])


def build_marts(run: Run) -> dict[str, DataFrame]:
    """The six marts. What several of them need from the facts is kept per key range."""
    refresh_parts(run)
    bookings = run.read("fact_bookings")
    hotels, customers = run.read("dim_hotels"), run.read("dim_customers")
    staff, rates = run.read_current("dim_staff"), run.read_current("dim_room_rates")
    monthly = marts.summed(run.read("part_bookings"), "hotel_id", "booking_month")
    booked, reviewed = marts.months_by_hotel(monthly), marts.summed(run.read("part_reviews"), "hotel_id")
    return {
        "mart_revenue": marts.revenue_from(monthly, hotels),
        "mart_occupancy": marts.occupancy_from(booked, hotels, rates),
        "mart_customer_segments": marts.mart_customer_segments(bookings, customers),
        "mart_satisfaction": marts.satisfaction_from(reviewed, hotels),
        "mart_staff": marts.mart_staff(staff, hotels),
        "mart_hotel_performance": marts.performance_from(hotels, booked, reviewed, staff),
    }


def refresh_marts(run: Run) -> StepResult:
    counts: dict[str, dict[str, int]] = {}

    def refresh(table: str, mart: DataFrame) -> None:
        rows, seen = _count(mart, rows=F.lit(True))
        run.replace(table, rows)
        counts[table] = dict(seen.get)

    together(run.store.spark, [lambda t=table, m=mart: refresh(t, m) for table, mart in build_marts(run).items()])
    return StepResult("refresh_marts", counts)


def run_pipeline(store: Store, batch_ts: str) -> list[StepResult]:
    """Run all steps once over what the feeds hold now. The first failing step ends the run:
    later steps do not start, nothing is published, and the error is logged and raised."""
    state = store.state()
    run = store.begin(state.run_id + 1, batch_ts, state)
    high: dict[str, int] = {}
    no_key: dict[str, int] = {}

    def look(feed: str) -> None:
        bad = parse_key(F.col(FEED_KEYS[feed])).isNull()
        high[feed], no_key[feed] = unread(store.read_raw(feed), state.offsets.get(feed, 0), bad)

    together(store.spark, [lambda f=feed: look(f) for feed in STAGERS])
    steps: list[tuple[str, Callable[[], StepResult]]] = [
        ("load_staging", lambda: load_staging(run, high, no_key)),
        ("load_dimensions", lambda: load_dimensions(run)),
        ("load_facts", lambda: load_facts(run)),
        ("refresh_marts", lambda: refresh_marts(run)),
    ]
    results: list[StepResult] = []
    log: list[tuple[str, str, datetime, str | None]] = []
    try:
        for name, step in steps:
            try:
                results.append(step())
            except Exception as err:
                log.append((name, FAILED, _now(), str(err)))
                raise
            log.append((name, SUCCEEDED, _now(), None))
        run.commit(high)
    finally:
        write_log(run, log)
    return results


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def write_log(run: Run, log: list[tuple[str, str, datetime, str | None]]) -> None:
    """Add the run's steps (four at most) to the run log."""
    scheduled = datetime.fromisoformat(run.batch_ts)
    rows = [(run.run_id, name, state, scheduled, done, error) for name, state, done, error in log]
    df = run.store.spark.createDataFrame(rows, LOG_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(run.store.path("run_log"))


def read_run_log(store: Store) -> DataFrame:
    spark: SparkSession = store.spark
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(store.path("run_log"))
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def recent_runs(log: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """Log rows scheduled within the last ``hours`` before ``now``."""
    since = timestamp_literal(now) - F.make_dt_interval(hours=F.lit(hours))
    return log.where((F.col("scheduled_time") >= since) & (F.col("scheduled_time") <= timestamp_literal(now)))


def run_history(store: Store, now: str, hours: int = 24) -> DataFrame:
    """Steps of the last ``hours``, newest first."""
    recent = recent_runs(read_run_log(store), now, hours)
    return recent.select("name", "state", "scheduled_time", "completed_time", "error_message").orderBy(
        F.col("scheduled_time").desc(), F.col("completed_time").desc()
    )
