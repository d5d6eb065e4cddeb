"""The warehouse layers derived from the two deliveries, for single-operator queries."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.plans import core, marts
from stayflow.plans.run import StepResult, together
from stayflow.plans.staging import STAGERS
from stayflow.schemas import KEY, TABLE_SCHEMAS
from stayflow.sources.files import timestamp_literal
from stayflow.sources.scratch import materialise, shared_dir
from stayflow.sources.store import Store
from stayflow.workload.feeds import RUN_TIMES, raw_batch

LAST_BATCH = 2


class Layers:
    """Every table as of a batch.

    What a run would find stored (raw rows, staging, earlier dimensions and facts) is written once
    per session and tables folder, and read from there by the queries that build on it; the
    ``apply_*`` methods do an operator's own work on top of those.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.stored: dict[str, DataFrame] = {}
        self.locks: dict[str, threading.Lock] = {}
        self.two_runs: tuple[Store, dict[int, list[StepResult]]] | None = None
        self.run_of_keys: tuple[Store, list[StepResult]] | None = None
        self.work = shared_dir(spark)

    def fresh_path(self, name: str) -> str:
        """A folder no other query uses."""
        return f"{self.work}/{name}-{uuid.uuid4().hex}"

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self.locks.setdefault(name, threading.Lock()):
            if name not in self.stored:
                self.stored[name] = materialise(build(), f"{self.work}/{name}")
            return self.stored[name]

    def store_all(self) -> None:
        """Write everything down, independent tables side by side."""
        staged = [(feed, batch) for feed in STAGERS for batch in RUN_TIMES]
        together(self.spark, [lambda s=s: self.staged(*s) for s in staged])
        together(
            self.spark,
            [
                self.hotels,
                *[lambda f=feed: self.versions(f) for feed in core.VERSIONED],
                *[lambda f=feed: self.fact(f) for feed in ("bookings", "reviews")],
            ],
        )
        self.performance()

    def ts(self, batch: int) -> Column:
        return timestamp_literal(RUN_TIMES[batch])

    def raw(self, feed: str, batch: int | None = None) -> DataFrame:
        """One delivery, or the whole append-only raw table."""
        if batch is None:
            return self.raw(feed, 1).unionByName(self.raw(feed, 2))
        first = None if batch == 1 else self.raw(feed, 1)
        return self.once(f"raw_{feed}-{batch}", lambda: raw_batch(self.spark, self.sf_dir, feed, batch, first))

    def stage_all(self, feed: str) -> DataFrame:
        """Staging load over the whole raw table."""
        return STAGERS[feed](self.raw(feed), RUN_TIMES[LAST_BATCH])

    def staged_all(self, feed: str) -> DataFrame:
        return self.once(f"stg_{feed}", lambda: self.stage_all(feed))

    def staged(self, feed: str, batch: int) -> DataFrame:
        return self.once(f"stg_{feed}-{batch}", lambda: STAGERS[feed](self.raw(feed, batch), RUN_TIMES[batch]))

    def apply_hotels(self, batch: int) -> DataFrame:
        before = self._empty("dim_hotels") if batch == 1 else self.hotels(batch - 1)
        return core.load_dim_hotels(before, self.staged("hotels", batch), self.ts(batch))

    def hotels(self, batch: int = LAST_BATCH) -> DataFrame:
        return self.once(f"dim_hotels-{batch}", lambda: self.apply_hotels(batch))

    def last_key(self, feed: str, batch: int) -> int:
        """Highest surrogate key in use after a batch."""
        return self.versions(feed, batch).agg(F.max(core.VERSIONED[feed].sk)).first()[0] or 0

    def apply_versions(self, feed: str, batch: int) -> DataFrame:
        table, last = core.VERSIONED[feed].table, 0
        before = self._empty(table)
        if batch > 1:
            before, last = self.versions(feed, batch - 1), self.last_key(feed, batch - 1)
        delivered = self.staged(feed, batch)
        return core.load_versioned(feed, before, delivered, self.ts(batch), last, self.fresh_path(table))

    def versions(self, feed: str, batch: int = LAST_BATCH) -> DataFrame:
        return self.once(f"{core.VERSIONED[feed].table}-{batch}", lambda: self.apply_versions(feed, batch))

    def apply_fact(self, feed: str, batch: int) -> DataFrame:
        load = {"bookings": core.load_fact_bookings, "reviews": core.load_fact_reviews}[feed]
        before = self._empty(f"fact_{feed}") if batch == 1 else self.fact(feed, batch - 1)
        return load(before, self.staged(feed, batch), self.versions("customers", batch), self.ts(batch))

    def fact(self, feed: str, batch: int = LAST_BATCH) -> DataFrame:
        return self.once(f"fact_{feed}-{batch}", lambda: self.apply_fact(feed, batch))

    def build_performance(self) -> DataFrame:
        return marts.mart_hotel_performance(
            self.hotels(), self.fact("bookings"), self.fact("reviews"), self.versions("staff")
        )

    def performance(self) -> DataFrame:
        return self.once("mart_hotel_performance", self.build_performance)

    def _empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], TABLE_SCHEMAS[table])


_BY_SESSION: dict[tuple[str, str], Layers] = {}


def layers_for(spark: SparkSession, sf_dir: str) -> Layers:
    """The session's layers over a tables folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BY_SESSION:
        _BY_SESSION[key] = Layers(spark, sf_dir)
    return _BY_SESSION[key]


def plain(df: DataFrame) -> DataFrame:
    """Output form shared with the checking engine: decimals as double, dates as text, and business
    keys as 64-bit numbers, which all keys of the given tables fit into."""
    shown = {"date": "string", "decimal": "double", KEY: "bigint"}
    return df.select(
        *[F.col(name).cast(shown.get(kind, shown.get(kind.split("(")[0], kind))).alias(name) for name, kind in df.dtypes]
    )
