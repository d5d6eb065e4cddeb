"""Append-only change feed over the raw tables.

A consumer owns one offset per feed: the highest batch it has taken in. Its unread rows are
the batches above that. Raw tables are partitioned by batch, so already read batches are
pruned and never scanned. Offsets are part of the run's commit record: they move only after
everything derived from the rows has been published, and a failed run sees its rows again.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.schemas import FEED_SCHEMAS


def read_changes(raw: DataFrame, low: int, high: int) -> DataFrame:
    """Rows appended after ``low`` up to and including ``high``."""
    return raw.where((F.col("_batch_id") > low) & (F.col("_batch_id") <= high))


def latest_batch(raw: DataFrame, offset: int) -> int:
    """Highest unread batch, or the offset itself when nothing is waiting."""
    top = raw.where(F.col("_batch_id") > offset).agg(F.max("_batch_id").alias("top")).first().top
    return offset if top is None else top


def unread(raw: DataFrame, offset: int, wrong: Column) -> tuple[int, int]:
    """``latest_batch`` and how many unread rows are ``wrong``, in one pass."""
    rows = raw.where(F.col("_batch_id") > offset)
    found = rows.agg(F.max("_batch_id").alias("top"), F.count_if(wrong).alias("wrong")).first()
    return offset if found.top is None else found.top, found.wrong


def feeds_ready(raw: Mapping[str, DataFrame], offsets: Mapping[str, int]) -> DataFrame:
    """One row with a boolean per feed: are there rows its consumer has not read?"""

    def waiting(feed: str) -> DataFrame:
        unread = raw[feed].where(F.col("_batch_id") > offsets.get(feed, 0))
        return unread.agg(F.max("_batch_id").isNotNull().alias("ready")).select(
            F.lit(feed).alias("feed"), "ready"
        )

    per_feed = reduce(DataFrame.unionByName, [waiting(feed) for feed in FEED_SCHEMAS])
    return per_feed.agg(
        *[
            F.bool_or(F.when(F.col("feed") == feed, F.col("ready"))).alias(f"{feed}_ready")
            for feed in FEED_SCHEMAS
        ]
    )
