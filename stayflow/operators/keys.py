"""Dense surrogate keys and global ranks without a single-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stayflow.sources.scratch import materialise

# monotonically_increasing_id() keeps the partition number above this bit and the row's
# place within its partition below it.
PLACE_BITS = 33
PLACE_MASK = (1 << PLACE_BITS) - 1


def _in_range_order(
    df: DataFrame, order: Sequence[Column], work_path: str, measures: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """Rows range-partitioned and sorted by ``order`` with their partition and place, and the
    ``measures`` observed while they were written.

    Range bounds come from a sample and may differ when recomputed, so the placement is
    written down before anything is derived from it.
    """
    placed, seen = df.repartitionByRange(*order).sortWithinPartitions(*order), Observation()
    if measures:
        placed = placed.observe(seen, *[m.alias(name) for name, m in measures.items()])
    stored = materialise(placed.withColumn("_slot", F.monotonically_increasing_id()), work_path)
    return stored.withColumns(
        {
            "_part": F.shiftright("_slot", PLACE_BITS),
            "_place": F.col("_slot").bitwiseAND(F.lit(PLACE_MASK)),
        }
    ), seen


def _part_offsets(placed: DataFrame, size: Column) -> DataFrame:
    """Rows in all earlier partitions. One row per shuffle partition, so both the window over
    them and the broadcast of them are bounded by the partition count."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(size.alias("_rows"))
    return sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))


def assign_keys(df: DataFrame, order: Sequence[Column], sk: str, last: int, work_path: str) -> DataFrame:
    """Add ``sk``: the integers after ``last``, without gaps, following ``order`` (unique)."""
    return assign_keys_observed(df, order, sk, last, work_path, {})[0]


def assign_keys_observed(
    df: DataFrame, order: Sequence[Column], sk: str, last: int, work_path: str, measures: Mapping[str, Column]
) -> tuple[DataFrame, Observation]:
    """``assign_keys``, and aggregates of ``df`` observed on the way."""
    placed, seen = _in_range_order(df, order, work_path, measures)
    offsets = F.broadcast(_part_offsets(placed, F.count(F.lit(1))))
    key = F.lit(last) + 1 + F.col("_offset") + F.col("_place")
    return placed.join(offsets, "_part").select(key.cast("bigint").alias(sk), *df.columns), seen


def global_rank(df: DataFrame, by: str, rank: str, work_path: str) -> DataFrame:
    """Add the rank by ``by``, highest first and NULL last; equal values share a rank.

    Rows are range-partitioned by the value and a running number, so a value shared by very many
    rows fills several partitions. A row's rank within its partition comes from a window over
    that partition; what precedes it, and the rank of a value that goes on from an earlier
    partition, is carried over from one row per partition.
    """
    numbered = df.withColumn("_number", F.monotonically_increasing_id())
    placed, _ = _in_range_order(numbered, [F.col(by).desc_nulls_last(), F.col("_number")], work_path)
    bounds = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min_by(F.struct(by), "_place").alias("_first"),
        F.max_by(F.struct(by), "_place").alias("_last"),
    )
    # One row per shuffle partition: small enough for one task and a broadcast.
    parts = Window.orderBy("_part")
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.withColumns(
        {
            "_offset": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            "_goes_on": F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(parts)), F.lit(False)),
        }
    )
    # The value that goes on began where the latest partition began another value: at that value's first row.
    inner = Window.partitionBy("_part").orderBy(F.col(by).desc_nulls_last())
    ranked = placed.withColumn("_rank", F.rank().over(inner))
    lasts = ranked.groupBy("_part").agg(F.max("_rank").alias("_last_rank"))
    bounds = bounds.join(lasts, "_part")
    # A partition of one value that goes on begins nothing; others begin their last value.
    begins = F.when(~F.col("_goes_on") | (F.col("_last_rank") > 1), F.col("_offset") + F.col("_last_rank"))
    carried = F.when(F.col("_goes_on"), F.last(begins, ignorenulls=True).over(before))
    bounds = bounds.select("_part", "_offset", carried.alias("_carried"))
    ranked = ranked.join(F.broadcast(bounds), "_part")
    place = F.when((F.col("_rank") == 1) & F.col("_carried").isNotNull(), F.col("_carried")).otherwise(
        F.col("_offset") + F.col("_rank")
    )
    return ranked.select(*df.columns, place.cast("bigint").alias(rank))
