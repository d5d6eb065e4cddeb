"""Joins of a large table with a delivery that is known to be small.

Every run counts the rows and text bytes it stages while writing them. A delivery within both
bounds below is broadcast, and the large table is read past it where it lies; anything larger
takes the shuffled joins, which have no size limit. A broadcast goes through the driver, and a run
makes some forty of them, so the bounds keep all of them together to a few hundred megabytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_DELTA_ROWS = 100_000
SMALL_DELTA_TEXT_BYTES = 16 * 1024 * 1024
# Tasks that write a small delta's new rows. Each may leave a file in every key range touched.
SMALL_DELTA_TASKS = 8


def is_small(rows: int, text_bytes: int = 0) -> bool:
    """``text_bytes`` may be left out where only numeric columns are broadcast."""
    return rows <= SMALL_DELTA_ROWS and text_bytes <= SMALL_DELTA_TEXT_BYTES


def small_semi(large: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``large`` with a key in ``small``; at most as many keys as ``small`` has."""
    return large.join(F.broadcast(small.select(*keys)), list(keys), "left_semi")


def small_anti(large: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``large`` without a key in ``small``."""
    return large.join(F.broadcast(small.select(*keys)), list(keys), "left_anti")
