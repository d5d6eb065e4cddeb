"""Exact removal of repeated byte strings, by suffix arrays of content-defined shards."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.rows import Work, add_columns
from stayflow.llm.suffix_array import common_prefixes, suffix_array


@dataclass(frozen=True)
class Settings:
    """``length``: bytes of a string that counts as repeated. ``gram``: bytes of the marks that
    bring equal strings together. ``shard_bytes``: text a shard has on average; shards grow in
    number with the input, not in size. ``records``: units a task sums up before it sends
    them on. ``sampled``: one text in so many is looked at beforehand for hot marks. ``shares``: the
    texts that a shard's open units leave are dealt into so many parts by mark, each with a suffix array
    of its own, as that takes many times its text in memory.
    """

    length: int = 50
    gram: int = 20
    shard_bytes: int = 8 << 20
    records: int = 400_000
    sampled: int = 64
    shares: int = 16

    @property
    def hot_bytes(self) -> int:
        """Text of one mark from which on its strings are dealt one by one."""
        return self.shard_bytes // 16


ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64(0xFFFFFFFF)
UNIT = np.dtype([("mark", "<u8"), ("own", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("lo", "<u4"), ("n", "<u4")])
RANGES = "doc bigint, tie bigint, lo bigint, hi bigint"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` bytes, from hashes of powers of two."""
    with np.errstate(over="ignore"):
        power, width, at, total = mixed(data.astype(np.uint64) + np.uint64(1)), 1, 0, None
        count = len(data) - size + 1
        while True:
            if size & width:
                part = power[at : at + count]
                total = part if total is None else total * ODD + part
                at += width
            if width * 2 > size:
                return mixed(total)
            power = mixed(power[:-width] * ODD + power[width:])
            width *= 2


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours."""
    least, n = values, 1
    while n * 2 <= width:
        least, n = np.minimum(least[:-n], least[n:]), n * 2
    if n < width:
        count = len(values) - width + 1
        least = np.minimum(least[:count], least[width - n : width - n + count])
    return least


def units_of(data: bytes, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mark, lo, n): the strings that start at lo to lo + n - 1 have the mark in common, the
    smallest hash of their grams. Equal strings have equal marks wherever they stand."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < settings.length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = least_in_windows(gram_hashes(raw, settings.gram), settings.length - settings.gram + 1)
    lo = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    return least[lo], lo, np.diff(np.append(lo, len(least)))


def packed(units: np.ndarray, compared: bool) -> list[bytes]:
    """A binary for each field. The bytes of a field stand by their place in the number, and documents as
    steps from one to the next, so that high bytes are runs of zeros, which a shuffle compresses.
    Hashes do not compress; they are left out of units that no others are ``compared`` with."""
    out = []
    for name in UNIT.names:
        values = np.ascontiguousarray(units[name])
        if name in ("mark", "own") and not compared:
            values = values[:0]
        if name == "doc":
            values = np.diff(values, prepend=np.int64(0))
        out.append(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())
    return out


def unpacked(fields: dict[str, bytes]) -> np.ndarray:
    """The units that ``packed`` was given; hashes that were left out are 0."""
    units = np.zeros(len(fields["doc"]) // 8, UNIT)
    for name in UNIT.names:
        if fields[name]:
            planes = np.frombuffer(fields[name], np.uint8).reshape(UNIT[name].itemsize, len(units))
            units[name] = np.ascontiguousarray(planes.T).view(UNIT[name])[:, 0]
    units["doc"] = np.cumsum(units["doc"])
    return units


def first_of_equal(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units split into those of the smallest document with the same text, one a text, and the
    others of larger documents. Of equal units of one document one is enough."""
    units = units[np.lexsort((units["doc"], units["own"], units["mark"]))]
    new = np.ones(len(units), bool)
    new[1:] = (units["mark"][1:] != units["mark"][:-1]) | (units["own"][1:] != units["own"][:-1])
    starts = np.flatnonzero(new)
    smallest = np.repeat(units["doc"][starts], np.diff(np.append(starts, len(units))))
    return units[new | (units["doc"] == smallest)], units[units["doc"] > smallest]


def joined_up(units: np.ndarray) -> np.ndarray:
    """Units, of which only the starts count from here on, with those that follow on one another as one."""
    if not len(units):
        return units
    units = units[np.lexsort((units["lo"], units["tie"], units["doc"]))]
    end = units["lo"].astype("i8") + units["n"]
    new = np.ones(len(units), bool)
    new[1:] = (units["doc"][1:] != units["doc"][:-1]) | (units["tie"][1:] != units["tie"][:-1]) | (units["lo"][1:] > end[:-1])
    starts = np.flatnonzero(new)
    out = units[starts]
    out["n"] = np.maximum.reduceat(end, starts) - out["lo"]
    return out


def strings_of(data: bytes, doc: int, tie: int, lo: int, length: int) -> np.ndarray:
    """Each string of a piece as a unit of its own, dealt by a hash of all its bytes."""
    units = np.empty(len(data) - length + 1, UNIT)
    view = memoryview(data)
    digests = b"".join([xxhash.xxh3_128_digest(view[i : i + length]) for i in range(len(units))])
    units["mark"], units["own"] = np.frombuffer(digests, "<u8").reshape(-1, 2).T
    units["doc"], units["tie"], units["n"] = doc, tie, 1
    units["lo"] = lo + np.arange(len(units))
    return units


def hot_marks(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Marks of so many different texts, by a sample, that they would make a shard large. The
    sample only balances tasks; results are the same for any list. No more marks than about one
    per ``hot_bytes`` of text come to the driver."""
    span = settings.length - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                data = text.as_buffer().to_pybytes()
                mark, lo, n = units_of(data, settings)
                own = [xxhash.xxh3_64_intdigest(data[a : a + b + span]) for a, b in zip(lo.tolist(), n.tolist())]
                arrays = [mark.view(np.int64), np.array(own, np.uint64).view(np.int64), n + span]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["mark", "own", "size"])

    some = texts.where(F.pmod(F.xxhash64("doc", "tie"), F.lit(settings.sampled)) == 0).select("text")
    units = some.mapInArrow(cut, "mark bigint, own bigint, size bigint").groupBy("mark", "own").agg(F.max("size").alias("size"))
    sizes = units.groupBy("mark").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    hot = sizes.where((F.col("size") * settings.sampled > settings.hot_bytes) & (F.col("n") >= 8))
    return np.sort(np.array([r.mark for r in hot.select("mark").collect()], np.int64).view(np.uint64))


def _ranges(units: np.ndarray) -> list[pa.Array]:
    columns = (units["doc"], units["tie"], units["lo"], units["lo"].astype("i8") + units["n"])
    return [pa.array(c.astype("i8")) for c in columns]


def repeated_ranges(texts: DataFrame, settings: Settings) -> DataFrame:
    """(doc, tie, lo, hi): starts lo to hi - 1 of strings that a smaller document has too.

    1. Texts are cut into units, the runs of starts whose strings share a mark, and units are
       dealt by mark. Each task first compares its own: of equal units only the smallest
       document's goes on, so a passage in very many documents is one record a task.
    2. In a shard, units with the text of a smaller document's unit are repeated as a whole.
       A mark that one text has alone, or one document, is done.
    3. Texts of the units left are fetched and dealt by mark again, more finely. Induced sorting gives
       the suffix array of a part's texts, common prefixes the runs of equal strings in it;
       all but those of the smallest document are repeated.

    Marks of very many texts, as at the ends of a passage in many documents, are not dealt whole:
    each of their strings is a unit with a hash of its bytes for a mark. They are found by a
    sample before step 1, and by the exact size of what is left before step 3.
    """
    work, spark = Work(texts.sparkSession), texts.sparkSession
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // settings.shard_bytes))
    records, span, hot = settings.records, settings.length - 1, hot_marks(texts, settings)

    def sent(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        first, later = first_of_equal(np.concatenate(held))
        # Repeated units ride along, in any shard; neighbours in the same one, where they join up.
        later = joined_up(later)
        places = mixed(later["doc"].view(np.uint64) * ODD + (later["lo"] >> np.uint32(16)))
        dealt = mixed(first["mark"])
        # In a shard half of a mark tells enough; equal texts agree in these 32 bits and the 64 of their own.
        first["mark"] &= LOW
        for state, units, key in ((0, first, dealt), (1, later, places)):
            shard = (key % np.uint64(shards)).astype(np.int64)
            units = units[np.lexsort((units["lo"], units["doc"], shard))]
            ends = np.cumsum(np.bincount(shard, minlength=shards))
            parts = np.split(units, ends[:-1])
            full = [i for i, part in enumerate(parts) if len(part)]
            columns = [pa.array(full, pa.int32()), pa.array([state] * len(full), pa.int32())]
            sent_as = [packed(parts[i], compared=not state) for i in full]
            for field in range(len(UNIT.names)):
                columns.append(pa.array([fields[field] for fields in sent_as], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["shard", "state", *UNIT.names])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for doc, tie, text in zip(*(batch.column(c) for c in ("doc", "tie", "text"))):
                data = text.as_buffer().to_pybytes()
                mark, lo, n = units_of(data, settings)
                if len(hot):
                    is_hot = hot[np.minimum(np.searchsorted(hot, mark), len(hot) - 1)] == mark
                    for a, b in zip(lo[is_hot].tolist(), n[is_hot].tolist()):
                        held.append(strings_of(data[a : a + b + span], doc.as_py(), tie.as_py(), a, settings.length))
                        count += b
                    mark, lo, n = mark[~is_hot], lo[~is_hot], n[~is_hot]
                units = np.empty(len(mark), UNIT)
                units["mark"], units["lo"], units["n"] = mark, lo, n
                units["doc"], units["tie"] = doc.as_py(), tie.as_py()
                view = memoryview(data)
                units["own"] = [xxhash.xxh3_64_intdigest(view[a : a + b + span]) for a, b in zip(lo.tolist(), n.tolist())]
                held.append(units)
                count += len(units)
                if count >= records:
                    yield from sent(held)
                    held, count = [], 0
        if count:
            yield from sent(held)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for doc, tie, lo, piece in zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "lo", "piece"))):
                held.append(strings_of(piece, doc, tie, lo, settings.length))
                count += len(held[-1])
                if count >= records:
                    yield from sent(held)
                    held, count = [], 0
        if count:
            yield from sent(held)

    def judge(table: pa.Table) -> pa.Table:
        parts = {0: [], 1: []}
        for row in table.select(["state", *UNIT.names]).to_pylist():
            parts[row["state"]].append(unpacked(row))
        first, later = first_of_equal(np.concatenate(parts[0] or [np.empty(0, UNIT)]))
        later = joined_up(np.concatenate([later, *parts[1]]))
        # A mark stays open if it has several texts and several documents.
        new = np.ones(len(first), bool)
        new[1:] = first["mark"][1:] != first["mark"][:-1]
        starts = np.flatnonzero(new)
        if len(starts):
            sizes = np.diff(np.append(starts, len(first)))
            differs = np.zeros(len(first), np.int64)
            differs[1:] = (first["own"][1:] != first["own"][:-1]) & ~new[1:]
            texts_of = np.add.reduceat(differs, starts)
            spread = np.maximum.reduceat(first["doc"], starts) > np.minimum.reduceat(first["doc"], starts)
            still = first[np.repeat((texts_of > 0) & spread, sizes)]
        else:
            still = first
        both = np.concatenate([later, still])
        marks = np.concatenate([np.zeros(len(later), np.uint64), still["mark"]]).view(np.int64)
        is_open = np.arange(len(both)) >= len(later)
        names = ["doc", "tie", "lo", "hi", "mark", "open"]
        return pa.Table.from_arrays([*_ranges(both), pa.array(marks), pa.array(is_open)], names)

    fields = ", ".join(f"{name} binary" for name in UNIT.names)
    units = texts.mapInArrow(cut, f"shard int, state int, {fields}")
    judged = units.groupBy("shard").applyInArrow(judge, f"{RANGES}, mark bigint, open boolean")
    judged = work.store(judged, "judged")
    work.release()

    def pieces_of(units: DataFrame) -> DataFrame:
        wanted = units.groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", "hi", "mark")).alias("units"))
        fetched = texts.join(wanted, ["doc", "tie"]).select(
            "doc", "tie", F.col("text").cast("binary").alias("data"), F.explode("units").alias("unit")
        )
        return fetched.select(
            "doc",
            "tie",
            "unit.lo",
            "unit.mark",
            F.substring("data", F.col("unit.lo").cast("int") + 1, (F.col("unit.hi") - F.col("unit.lo") + span).cast("int")).alias("piece"),
        )

    def induce(table: pa.Table) -> pa.Table:
        doc, tie, lo = (table.column(c).to_numpy() for c in ("doc", "tie", "lo"))
        texts_here = table.column("piece").to_pylist()
        sizes = np.array([len(t) for t in texts_here], np.int64)
        # Bytes become 1 to 256; 0 ends a text, so no common prefix that counts goes beyond it.
        joined = b"".join(texts_here)
        string = np.zeros(len(joined) + len(sizes), np.uint16)
        ends = np.cumsum(sizes + 1)
        inside = np.ones(len(string), bool)
        inside[ends - 1] = False
        string[inside] = np.frombuffer(joined, np.uint8).astype(np.uint16) + 1
        order = np.array(suffix_array(string, 257))
        shared, owner = common_prefixes(string, order), np.repeat(np.arange(len(sizes)), sizes + 1)
        starts_ok = (ends - 1)[owner] - np.arange(len(string)) >= settings.length
        # Runs of neighbours whose strings are equal. Suffixes too short for a string have no
        # equal neighbour that is long enough, so they end a run.
        long_enough = starts_ok[order]
        fresh = (shared[order] < settings.length) | ~long_enough
        fresh[0] = True
        heads = np.flatnonzero(fresh)
        docs_here = doc[owner[order]]
        smallest = np.repeat(np.minimum.reduceat(docs_here, heads), np.diff(np.append(heads, len(order))))
        hit = np.sort(order[long_enough & (docs_here > smallest)])
        # Starts that follow on one another are one range; between two texts is a start that is too late.
        new = np.flatnonzero(np.diff(hit, prepend=-2) > 1)
        own, n = owner[hit[new]], np.diff(np.append(new, len(hit)))
        place = lo[own] + hit[new] - (ends - sizes - 1)[own]
        columns = [doc[own], tie[own], place, place + n]
        return pa.Table.from_arrays([pa.array(c.astype("i8")) for c in columns], ["doc", "tie", "lo", "hi"])

    still_open = judged.where("open")
    sizes = still_open.groupBy("mark").agg(F.sum(F.col("hi") - F.col("lo") + span).alias("size"))
    # Bounded: so large a mark fills a sixteenth of a shard.
    large = sizes.where(F.col("size") > settings.hot_bytes).select("mark")
    found = judged.where("not open").select("doc", "tie", "lo", "hi")
    if not large.isEmpty():
        strings = pieces_of(still_open.join(F.broadcast(large), "mark", "left_semi")).mapInArrow(split, f"shard int, state int, {fields}")
        # Open here are different strings whose marks agree by chance.
        one_by_one = strings.groupBy("shard").applyInArrow(judge, f"{RANGES}, mark bigint, open boolean").where("not open")
        found = found.unionByName(one_by_one.select("doc", "tie", "lo", "hi"))
        still_open = still_open.join(F.broadcast(large), "mark", "left_anti")
    dealt = pieces_of(still_open).withColumn("shard", F.pmod("mark", F.lit(shards * settings.shares)))
    ranges = work.store(dealt.groupBy("shard").applyInArrow(induce, RANGES).unionByName(found), "ranges")
    work.drop(judged)
    work.release()
    return ranges


def remove_repeated_bytes(
    df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``df`` with ``n_bytes``, ``removed`` (array of start, end of removed byte runs) and
    ``kept`` (the other bytes of the text in UTF-8, joined).

    Removed is every byte covered by a string of ``length`` bytes that also starts in a
    row with a smaller key; strings are judged on the input and lie within one row. Null texts
    are empty. Keys are integers; rows with null keys keep their bytes and are no source. Rows
    of one key are separate documents, none smaller than the other.
    """
    span = settings.length - 1
    keys = df.select(F.col(key).cast("long").alias("doc")).where("doc is not null")
    # A hash of the text tells rows of one key apart; it does not compress, so only where there are any.
    repeated = not keys.groupBy("doc").count().where("count > 1").isEmpty()
    tie = F.xxhash64(text) if repeated else F.lit(0).cast("long")
    base = df.select(F.col(key).cast("long").alias("doc"), tie.alias("tie"), F.col(text).alias("text"))
    texts = base.where("doc is not null and text is not null")
    ranges = repeated_ranges(texts, settings).groupBy("doc", "tie")
    ranges = ranges.agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")).select(F.struct("*").alias("_found"))
    made = ["n_bytes", "removed", "kept"]
    kept = [c for c in df.columns if c not in made]
    # The row in one column of its own: its column names may be those used here.
    tagged = df.select(F.struct(*kept).alias("_row"), F.col(key).cast("long").alias("_doc"), tie.alias("_tie"))
    same = (F.col("_doc") == F.col("_found.doc")) & (F.col("_tie") == F.col("_found.tie"))
    met = tagged.join(ranges, same, "left")
    both = F.struct(
        F.coalesce(F.col("_row").getField(text), F.lit("")).cast("binary").alias("data"),
        F.col("_found.ranges.lo").alias("lo"),
        F.col("_found.ranges.hi").alias("hi"),
    )
    joined = met.select("_row.*", both.alias("_both"))

    def make():
        def work(row):
            data = row["data"]
            if not row["lo"]:
                return len(data), [], data
            lo, hi = np.array(row["lo"]), np.array(row["hi"]) + span
            order = np.argsort(lo, kind="stable")
            lo, reach = lo[order], np.maximum.accumulate(hi[order])
            new = np.append(True, lo[1:] > reach[:-1])
            starts = lo[new].tolist()
            stops = reach[np.append(np.flatnonzero(new)[1:], len(lo)) - 1].tolist()
            left = b"".join(data[a:b] for a, b in zip([0, *stops], [*starts, len(data)]))
            return len(data), [{"start": a, "end": b} for a, b in zip(starts, stops)], left

        return work

    done = add_columns(joined, "_both", "n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary", make)
    return done.drop("_both")
