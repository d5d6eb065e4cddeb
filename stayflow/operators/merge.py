"""Keyed merge of a delta into a target."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions.measures import changed
from stayflow.operators.delta import SMALL_DELTA_TASKS, small_semi

INSERT, UPDATE, KEEP = "insert", "update", "keep"


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` as is, but the job fails when two rows share a key. The window needs the same
    partitioning and sort as a merge join on ``keys``, so before one it adds no shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    complaint = F.raise_error(F.lit(f"duplicate source key in merge on {', '.join(keys)}"))
    checked = df.withColumn("_copy", place)
    return checked.where(F.when(F.col("_copy") == 1, F.lit(True)).otherwise(complaint.cast("boolean"))).drop(
        "_copy"
    )


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    update: Sequence[str],
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    small_source: bool = False,
) -> DataFrame:
    """The target after the merge, with ``_action`` telling what happened to each row.

    A matched row whose ``compare`` columns differ takes the ``update`` columns from the
    source and the ``on_update`` values; an unmatched source row is inserted with all columns
    it has and the ``on_insert`` values; every other row is kept.

    Normally one full outer join: both sides hold a key at most once, so neither can be
    skewed. ``small_source`` is for a source counted to be small (see ``delta``): the columns
    an update needs are broadcast, and the target is only streamed past them, unshuffled.
    """
    on_update, on_insert = on_update or {}, on_insert or {}
    source = unique_on(source, keys)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    match = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    differs = F.col("_in_source") & changed("t", "s", compare)

    def incoming(c: str) -> Column:
        return F.col(f"s.{c}") if c in source.columns else F.lit(None)

    def inserted(c: str) -> Column:
        return on_insert.get(c, incoming(c))

    def matched(c: str) -> Column:
        old = F.col(f"t.{c}")
        if c in keys or c not in update and c not in on_update:
            return old
        return F.when(F.col("_action") == UPDATE, on_update.get(c, incoming(c))).otherwise(old)

    def rows(df: DataFrame, action: Column, value: Callable[[str], Column]) -> DataFrame:
        typed = [value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns]
        return df.withColumn("_action", action).select(*typed, "_action")

    if small_source:
        present = small_semi(target.select(*keys), source, keys)
        new = source.join(present, list(keys), "left_anti").coalesce(SMALL_DELTA_TASKS).alias("s")
        needed = [c for c in source.columns if c in {*keys, *compare, *update}]
        old = t.join(F.broadcast(s.select(*needed, "_in_source").alias("s")), match, "left")
        kept = rows(old, F.when(differs, UPDATE).otherwise(KEEP), matched)
        return kept.unionByName(rows(new, F.lit(INSERT), inserted))

    def either(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        return F.when(F.col("_action") == INSERT, inserted(c)).otherwise(matched(c))

    action = F.when(F.col("_in_target").isNull(), INSERT).when(differs, UPDATE).otherwise(KEEP)
    return rows(t.join(s, match, "full_outer"), action, either)


def merge_upsert(target: DataFrame, source: DataFrame, *args, **kwargs) -> DataFrame:
    """``merge_actions`` without the action column."""
    return merge_actions(target, source, *args, **kwargs).drop("_action")
