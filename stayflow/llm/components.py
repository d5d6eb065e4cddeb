"""Connected components by alternating star contractions, one table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.rows import Work


def components(edges: DataFrame, work: Work) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Each round points every node at the smallest of its neighbourhood, first its larger
    neighbours and then its smaller ones, until the edges are stars. Rounds grow with the
    logarithm of the longest chain. A round pre-aggregates the smallest neighbour, so a
    node with very many neighbours is one row there, and its edges are joined back with
    Spark's skew handling. Each round is a stored table; the last two are kept.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    now = work.store(now.distinct(), "edges")
    before = None
    while True:
        large = _star(now, both=True)
        small = _star(large, both=False).distinct()
        after = work.store(small, "edges")
        same = _digest(after) == _digest(now)
        work.drop(*([before] if before is not None else []))
        before, now = now, after
        if same:
            break
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Edges (u, v), u > v. ``both``: every node links its larger neighbours to the smallest
    node of its neighbourhood; otherwise it links its smaller ones (and itself) to it."""
    if both:
        turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        around = edges.unionByName(turned)
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    linked = around.join(least, "u")
    if both:
        least_or_self = F.least("m", "u")
        return linked.where("v > u").select(F.col("v").alias("u"), least_or_self.alias("v"))
    others = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def _digest(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(hashed), F.bit_xor(F.xxhash64(hashed))).first()
    return tuple(row)
