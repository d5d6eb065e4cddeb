"""Joining several facts to one dimension without multiplying rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_preaggregated(dim: DataFrame, aggregates: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """``dim`` left-joined to aggregates that hold one row per key.

    Each fact is brought to the dimension's grain on its own first: joining the facts
    themselves would pair every booking of a hotel with every review and every employee.
    """
    for aggregate, key in aggregates:
        dim = dim.join(aggregate, key, "left")
    return dim
