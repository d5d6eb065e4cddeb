"""Looking up one dimension row per fact row, also when a few keys hold most facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.measures import same
from stayflow.operators.delta import small_semi
from stayflow.sources.scratch import materialise, shared_dir

# Entries of a task's sketch, and of the merged ones per key that may be listed. A key that is hot
# in the whole is frequent in most tasks, so these few follow it.
TRACKED_IN_A_TASK = 1000
TRACKED_PER_KEY = 10
LEAST_TRACKED = 1000
# Groups of input partitions whose sketches are merged before the final merge.
SKETCH_GROUPS = 256
# Slots per shuffle partition a hot key fills, so that slots even out over partitions.
SLOTS_PER_PARTITION = 4


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def is_broadcast(right: DataFrame) -> bool:
    """Is ``right``, by the size Spark knows or estimates it to be, within its broadcast limit?"""
    limit = right.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Hot keys with the number of ``_slots`` their rows should be spread over.

    A key is hot when it alone fills more than an average shuffle partition, so there are at
    most as many as partitions. One pass over the key column: every input partition keeps a
    sketch of its frequent keys, and sketches are merged in two levels, so nothing is shuffled
    by key and no task takes the sketches of all partitions. A sketch may misjudge a key near the
    limit; that costs a little replication or evenness. As sketches depend on the order they are
    merged in, the list has to be stored before both sides of a join use it.
    """
    limit = shuffle_partitions(df)
    partitions, share = limit, 1 / limit
    tracked = F.lit(max(TRACKED_PER_KEY * limit, LEAST_TRACKED))
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    grouped = df.groupBy(group.alias("_group")).agg(
        F.call_function("approx_top_k_accumulate", F.col(key), F.lit(TRACKED_IN_A_TASK)).alias("sketch"),
        F.count(F.lit(1)).alias("rows"),
    )
    # Grouped by a constant: without groups, input partitions that got no sketch would fail.
    merged = grouped.groupBy(F.lit(0).alias("_all")).agg(
        F.call_function("approx_top_k_combine", F.col("sketch"), tracked).alias("sketch"),
        F.sum("rows").alias("rows"),
    )
    top = F.explode(F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(limit)))
    part_of_all = F.col("top.count") / F.col("rows")
    return (
        merged.select(top.alias("top"), "rows")
        .where((part_of_all > share) & F.col("top.item").isNotNull())
        .select(
            F.col("top.item").alias(key),
            F.ceil(part_of_all * partitions * SLOTS_PER_PARTITION).cast("int").alias("_slots"),
        )
    )


def lookup_left(df: DataFrame, right: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``df`` left-joined to ``right`` (unique on ``key``), with hot and NULL keys spread.

    Rows of a hot key get a slot from a hash of ``spread_by`` and the one matching row of
    ``right`` is repeated per slot; all repeats together are a few rows per shuffle partition.
    Rows without a key match nothing but would all hash to one task; they are spread too.
    The list of hot keys is stored, so both sides see the same one. Where Spark's own size check
    will broadcast ``right``, no key can be too hot, and neither sketch nor slots are needed.
    """
    if is_broadcast(right):
        return df.join(right, key, "left").select(*df.columns, *[c for c in right.columns if c != key])
    hot = F.broadcast(materialise(hot_keys(df, key), f"{shared_dir(df.sparkSession)}/hot"))
    every = F.lit(shuffle_partitions(df) * SLOTS_PER_PARTITION)
    spread = F.when(F.col(key).isNull(), every).otherwise(F.coalesce("_slots", F.lit(1)))
    slot = F.pmod(F.xxhash64(spread_by), spread).cast("int")
    left = df.join(hot, key, "left").withColumn("_slot", slot).drop("_slots")
    slots = F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1)
    repeated = right.join(hot, key, "left").withColumn("_slot", F.explode(slots)).drop("_slots")
    added = [c for c in right.columns if c != key]
    return left.join(repeated, [key, "_slot"], "left").select(*df.columns, *added)


def lookup_current_sk(
    df: DataFrame, dim: DataFrame, bk: str, sk: str, spread_by: str, small: bool = False
) -> DataFrame:
    """Surrogate key of the current dimension version; NULL where the member is unknown.

    ``small``: ``df`` is counted to be small. The dimension is then narrowed to its members by
    a broadcast, and what is joined is small on both sides whatever its keys look like.
    """
    current = dim.where(F.col("is_current")).select(bk, sk)
    if small:
        return df.join(F.broadcast(small_semi(current, df, [bk])), bk, "left").select(*df.columns, sk)
    return lookup_left(df, current, bk, spread_by)


def unmatched(src: DataFrame, dim: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Source rows with no equal row in ``dim``. Strict equality never matches a NULL;
    ``null_safe`` treats two NULLs as equal. Both run as hash-partitioned anti joins."""
    return src.alias("s").join(dim.select(*on).alias("d"), same("s", "d", on, null_safe), "left_anti")
