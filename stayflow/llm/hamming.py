"""Exact nearest binary codes by multi-index hashing with growing segment radii."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.rows import Work

BITS = 64


def sign_code(vector: str) -> Column:
    """64-bit code of a vector: bit i is set where component i is above 0. Components from 64 on
    fold onto the bits again by exclusive or; null components count as 0, a null vector has no code."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def bit(x: Column, i: Column) -> Column:
        return F.when(x > 0, F.call_function("shiftleft", one, i % BITS)).otherwise(zero)

    bits = F.transform(vector, bit)
    return F.aggregate(bits, zero, lambda a, b: a.bitwiseXOR(b))


def nearest(
    rows: DataFrame, queries: DataFrame, k: int, key: str = "id", code: str = "code", segments: int | None = None
) -> DataFrame:
    """(query, neighbour, distance, place) of the ``k`` rows nearest to each query.

    Nearness is Hamming distance of the 64-bit codes, ties by key; a row with the query's own
    key is not its neighbour. Null keys and codes are left out; of a repeated key its smallest
    code counts. Fewer than ``k`` neighbours are given only where there are no more.

    Codes are cut into ``segments`` (4; 8 for a few thousand codes, so that values of a segment
    are about as many as codes), each with an index from its value to codes. In round r every open
    query looks up the values at distance r in each segment. Codes not met by then differ by
    more than r in every segment, so by ``segments * (r + 1)`` or more: a query whose k-th
    verified distance is below that is done and leaves. Until then nothing farther than that
    distance is taken any more. A pair is taken only in the first of its
    closest segments, so none is verified twice. Equal codes are one entry with their first
    ``k + 1`` keys, and equal queries one query, so a code that very many rows share costs as
    one. Of what a query has met the best are kept after each round, with a limit before the
    shuffle.
    """
    work = Work(rows.sparkSession)
    need = k + 1  # the query itself may be among the rows
    known = _single(rows, key, code)
    first = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    listed = known.withColumn("n", first).where(F.col("n") <= need)
    codes = listed.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    codes = work.store(codes, "codes")
    segments = segments or (4 if codes.count() > 1 << 12 else 8)
    width = BITS // segments
    asked = work.store(_single(queries, key, code), "queries")
    index = work.store(codes.select(_segments("code", segments, width), "code"), "index")
    need = min(need, known.count())
    start = asked.select("code").distinct().withColumn("far", F.lit(BITS))
    open_queries = work.store(start, "open")
    best, done = None, []
    for radius in range(width + 1):
        if need == 0 or open_queries.isEmpty():
            break
        met = _met(open_queries, index, radius, segments, width)
        met = met if best is None else met.unionByName(best.drop("ids"))
        best = work.store(_closest(met, codes, need), "best")
        covered = segments * (radius + 1) - 1
        state = best.groupBy("q").agg(F.sum(F.size("ids")).alias("n"), F.max("distance").alias("most"))
        has_all = F.col("n") >= need
        ended = has_all & (F.col("most") <= covered) if radius < width else F.lit(True)
        state = work.store(state.select("q", "most", has_all.alias("has_all"), ended.alias("ended")), "state")
        full = state.where("ended").select("q")
        done.append(best.join(full, "q", "left_semi"))
        best = best.join(full, "q", "left_anti")
        left = open_queries.join(state, F.col("code") == F.col("q"), "left")
        far = F.when(F.col("has_all"), F.col("most")).otherwise(F.lit(BITS)).alias("far")
        open_queries = work.store(left.where(~F.coalesce("ended", F.lit(False))).select("code", far), "open")
    kind = rows.schema[key].dataType.simpleString()
    if not done:
        ddl = f"query {kind}, neighbour {kind}, distance int, place int"
        return rows.sparkSession.createDataFrame([], ddl)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    each = found.select("q", "distance", F.explode("ids").alias("neighbour"))
    pairs = asked.join(each, F.col("code") == F.col("q")).where(F.col("id") != F.col("neighbour"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    placed = pairs.select(F.col("id").alias("query"), "neighbour", "distance", place.alias("place"))
    return placed.where(F.col("place") <= k)


def _single(df: DataFrame, key: str, code: str) -> DataFrame:
    known = df.select(F.col(key).alias("id"), F.col(code).cast("long").alias("code")).na.drop()
    return known.groupBy("id").agg(F.min("code").alias("code"))


def _segments(code: str, segments: int, width: int) -> Column:
    """One row per segment: its number and value."""
    parts = [
        F.struct(F.lit(s).alias("segment"), _part(F.col(code), s, width).alias("value")) for s in range(segments)
    ]
    return F.inline(F.array(*parts))


def _part(code: Column, segment: int, width: int) -> Column:
    return F.shiftrightunsigned(code, segment * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _met(queries: DataFrame, index: DataFrame, radius: int, segments: int, width: int) -> DataFrame:
    """(q, code, distance) of the pairs whose closest segment is at this radius."""
    masks = [str(sum(1 << i for i in bits)) for bits in combinations(range(width), radius)]
    flips = F.split(F.lit(",".join(masks)), ",").cast("array<int>")  # one constant
    # Stored queries may lie in one file; each becomes many rows here, so they are dealt out first.
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = queries.repartition(tasks, "code").select(F.col("code").alias("q"), "far", _segments("code", segments, width))
    probes = parts.select("q", "far", "segment", "value", F.explode(flips).alias("flip"))
    probes = probes.select("q", "far", "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    # Spark sizes the probes as if they had not been multiplied, and must not broadcast them.
    pairs = probes.hint("merge").join(index, ["segment", "value"])
    unlike = F.col("q").bitwiseXOR(F.col("code"))
    apart = [F.bit_count(_part(unlike, s, width)) for s in range(segments)]
    taken = F.bit_count(unlike) <= F.col("far")
    for s in range(segments):
        # An earlier segment as close, or any closer one, has this pair already.
        taken = taken & F.when(F.col("segment") > s, apart[s] > radius).otherwise(apart[s] >= radius)
    return pairs.where(taken).select("q", "code", F.bit_count(unlike).alias("distance"))


def _closest(met: DataFrame, codes: DataFrame, need: int) -> DataFrame:
    """Of each query's pairs those that may hold its ``need`` nearest keys, with these keys."""
    near = met.withColumn("n", F.rank().over(Window.partitionBy("q").orderBy("distance"))).where(F.col("n") <= need)
    keyed = near.select("q", "code", "distance").join(codes, "code")
    order = Window.partitionBy("q").orderBy("distance", F.col("ids")[0])
    own = keyed.withColumn("n", F.row_number().over(order)).where(F.col("n") <= need)
    before = Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
    kept = own.withColumn("closer", F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0)))
    return kept.where(F.col("closer") < need).select("q", "code", "distance", "ids")
