"""Latest row per key, and the filter on unusable keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions.parse import parse_key

LOAD_COLUMNS = ("_loaded_at", "_filename", "_batch_id")


def dedup_latest(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``.

    Spark limits every input partition to one row per key before the shuffle
    (``WindowGroupLimit``), so a key with very many copies sends at most one row per map
    task to the task that picks the winner.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def latest_first(df: DataFrame) -> list[Column]:
    """Load time decides; file name and then the business columns break ties, so the winner
    does not depend on how the rows happen to be partitioned."""
    business = [c for c in df.columns if c not in LOAD_COLUMNS]
    return [F.col(c).desc_nulls_last() for c in ("_loaded_at", "_filename", *business)]


def require_key(df: DataFrame, col: str) -> DataFrame:
    """Only rows whose key text is a number."""
    return df.where(parse_key(F.col(col)).isNotNull())


def without_key(df: DataFrame, col: str) -> DataFrame:
    """The other rows: the ones ``require_key`` leaves out."""
    return df.where(parse_key(F.col(col)).isNull())


def latest_by_number(df: DataFrame, col: str) -> DataFrame:
    """Rows with a usable key, latest per key value: ``'1'``, ``'01'`` and ``' 1'`` are one key.

    The unusable keys go first: they would otherwise all meet in one task.
    """
    return dedup_latest(require_key(df, col), [parse_key(F.col(col))], latest_first(df))
