"""Versioned dimensions (type 2): close the version that changed, open the next one.

Versions are half-open intervals ``[eff_from, eff_to)``: the closed version ends at the very
timestamp the next one starts. A member that is not delivered stays as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.measures import changed
from stayflow.operators.delta import small_anti, small_semi
from stayflow.operators.keys import assign_keys
from stayflow.operators.lookup import unmatched


@dataclass(frozen=True)
class Versioned:
    """A versioned dimension: business key, surrogate key, the columns whose change opens a
    new version, and the columns that are only carried along."""

    table: str
    key: str
    sk: str
    tracked: tuple[str, ...]
    carried: tuple[str, ...] = ()


def closing(ts: Column) -> dict[str, Column]:
    return {"eff_to": ts, "is_current": F.lit(False)}


def scd2_expire(dim: DataFrame, src: DataFrame, spec: Versioned, ts: Column) -> DataFrame:
    """The dimension with every current version whose tracked columns differ from the
    delivered row closed at ``ts``. Closed versions take no part in the join."""
    current = dim.where("is_current").alias("t")
    delivered = src.select(spec.key, *spec.tracked).withColumn("_delivered", F.lit(True)).alias("s")
    joined = current.join(delivered, F.col(f"t.{spec.key}") == F.col(f"s.{spec.key}"), "left")
    expired = F.coalesce(F.col("_delivered") & changed("t", "s", spec.tracked), F.lit(False))
    stamped = {c: F.when(expired, v).otherwise(F.col(f"t.{c}")) for c, v in closing(ts).items()}
    rewritten = joined.select(*[stamped.get(c, F.col(f"t.{c}")).alias(c) for c in dim.columns])
    return dim.where(~F.col("is_current")).unionByName(rewritten)


def scd2_insert(
    dim: DataFrame,
    src: DataFrame,
    spec: Versioned,
    ts: Column,
    last: int,
    work_path: str,
    null_safe: bool = True,
) -> DataFrame:
    """New versions for delivered rows without an identical current version, keyed after
    ``last`` in order of the business key.

    With strict equality a row holding a NULL in a tracked column never finds its identical
    version and is added again on every delivery; the pipeline therefore compares null-safe.
    """
    fresh = unmatched(src, dim.where("is_current"), [spec.key, *spec.tracked], null_safe)
    rows = fresh.select(spec.key, *spec.carried, *spec.tracked)
    return open_versions(
        assign_keys(rows, [F.col(spec.key)], spec.sk, last, work_path), dim.columns, ts
    )


def open_versions(rows: DataFrame, columns: list[str], ts: Column) -> DataFrame:
    version = {
        "eff_from": ts,
        "eff_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
        "_loaded_at": ts,
    }
    return rows.withColumns(version).select(*columns)


def carry_over(current: DataFrame, opened: DataFrame, key: str, small: bool = False) -> DataFrame:
    """Current versions that stay current. ``small``: ``opened`` is counted to be small."""
    stay = small_anti(current, opened, [key]) if small else current.join(opened.select(key), key, "left_anti")
    return stay.select(*current.columns)


def close_replaced(
    current: DataFrame, opened: DataFrame, key: str, ts: Column, small: bool = False
) -> DataFrame:
    """Current versions replaced by an opened one, closed at ``ts``."""
    gone = small_semi(current, opened, [key]) if small else current.join(opened.select(key), key, "left_semi")
    return gone.withColumns(closing(ts)).select(*current.columns)


def scd2_apply(
    dim: DataFrame,
    src: DataFrame,
    spec: Versioned,
    ts: Column,
    last: int,
    work_path: str,
    null_safe: bool = True,
) -> DataFrame:
    """The whole dimension after one delivery, history included.

    The opened versions are written down once (they are no more than the delivery) and both
    the rows that stay and the rows that close follow from their keys, so the dimension is
    never shuffled when the delivery is small enough for Spark to broadcast it.
    """
    opened = scd2_insert(dim, src, spec, ts, last, work_path, null_safe)
    if not null_safe:
        return scd2_expire(dim, src, spec, ts).unionByName(opened)
    current = dim.where("is_current")
    return (
        dim.where(~F.col("is_current"))
        .unionByName(carry_over(current, opened, spec.key))
        .unionByName(close_replaced(current, opened, spec.key, ts))
        .unionByName(opened)
    )
