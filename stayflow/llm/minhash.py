"""Near duplicates: signatures in an inverted index of their coordinates, links confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.components import components
from stayflow.llm.remembered import KEPT
from stayflow.llm.rows import Work, add_columns


@dataclass(frozen=True)
class Settings:
    """``words``: words of a shingle. ``percent``: least Jaccard similarity of a link, in
    hundredths. ``coordinates`` and ``least_matches``: signature length, and equal coordinates
    a pair needs. With 64 and 34 a pair of similarity 0.8 is missed with a likelihood under 1e-6.
    ``compared``: members of a list up to which all are compared with one another, by sketches.
    ``parity_bits``: bits of a set's parity, 64 times a number. ``sent``: keys up to which those whose texts are
    wanted are sent to all tasks; for more, all texts are shuffled.
    """

    words: int = 5
    percent: int = 80
    coordinates: int = 64
    least_matches: int = 34
    compared: int = 64
    parity_bits: int = 1024
    sent: int = 1_000_000


class Hashes(dict):
    """64-bit hash of a word; remembers the words it has seen."""

    REMEMBERED = 100_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.REMEMBERED and len(word) <= 64:
            self[word] = value
        return value


ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles.

    Words are stretches without ASCII white space, A-Z in lower case. Fewer words than a
    shingle needs are one shingle; without words the set is empty.
    """
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(codes))
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) - size + 1, np.uint64)
        for i in range(size):
            total = mixed(total * ODD + codes[i : len(codes) - size + 1 + i] + np.uint64(size))
    return np.unique(total)


@lru_cache(maxsize=4)
def multipliers(coordinates: int) -> np.ndarray:
    return np.random.default_rng(20_011).integers(1, 2**63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Smallest value of each of the hash functions over the set, 32 bits of it."""
    factors, least = multipliers(coordinates), None
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 4096):
            values = shingles[None, start : start + 4096] * factors[:, None]
            values = ((values ^ (values >> np.uint64(29))) * MIX).min(axis=1)
            least = values if least is None else np.minimum(least, values)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


SKETCHED = 4


def sketch(values: np.ndarray) -> np.ndarray:
    """The low ``SKETCHED`` bits of a signature's coordinates: of every 64 the first bits in one number,
    then the second ones, and so on. Coordinates that differ here differ."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint32)
    padded[: len(values)] = values.view(np.uint32)
    bits = (padded.reshape(-1, 1, 64) >> np.arange(SKETCHED, dtype=np.uint32)[None, :, None]) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").reshape(-1).view("<i8")


def parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Bit i tells whether an odd number of shingles fall on i. Every shingle that only one of two
    sets has changes one bit, so the sets differ in as many shingles, at least, as their parities in bits."""
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def word_hashes() -> Hashes:
    return KEPT.get("minhash", "hashes", None, Hashes)


def shingle_sets(df: DataFrame, text: str, settings: Settings, narrow: bool = False) -> DataFrame:
    """Add ``shingles``, the packed set of each text, and its ``set_key``. ``narrow``: only 32
    bits of every shingle are packed."""
    words = settings.words

    def make():
        hashes = word_hashes()

        def work(value):
            shingles = shingle_set(value, words, hashes)
            packed = shingles.tobytes()
            short = np.unique((shingles >> np.uint64(32)).astype(np.uint32)).tobytes() if narrow else packed
            return short, xxhash.xxh3_128_digest(packed)

        return work

    return add_columns(df, text, "shingles binary, set_key binary", make)


def signatures(df: DataFrame, text: str, settings: Settings) -> DataFrame:
    """Add ``n_shingles``, ``set_key`` (equal for equal sets), ``signature``, its ``sketch`` and the
    set's ``parity`` (null if empty)."""
    words, coordinates, bits = settings.words, settings.coordinates, settings.parity_bits

    def make():
        hashes = word_hashes()

        def work(value):
            shingles = shingle_set(value, words, hashes)
            if not len(shingles):
                return 0, None, None, None, None
            key, values = xxhash.xxh3_128_digest(shingles.tobytes()), signature(shingles, coordinates)
            return len(shingles), key, values.tolist(), sketch(values).tolist(), parity(shingles, bits).tolist()

        return work

    made = "n_shingles bigint, set_key binary, signature array<int>, sketch array<bigint>, parity array<bigint>"
    return add_columns(df, text, made, make)


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    Rows are linked whose shingle sets are similar enough; ``component_id`` is the smallest key
    reachable, ``kept`` marks the rows that carry it. Null and empty texts have no shingles and
    are linked with nothing; null keys neither. Rows of a repeated key are one document: one
    of their sets stands for all.

    1. Equal sets become one class under their smallest key.
    2. The signature is cut into spans of neighbouring coordinates, as long as two signatures with
       ``least_matches`` equal coordinates always have some spans equal as a whole (two
       coordinates, at 64 and 34: 32 spans, two of them equal at least). Every class is posted
       under its rarest (span, values): it may leave out the most frequent ones, one less than a similar pair has equal
       (seven of 32 with all but a likelihood of 2.5e-7), as it still meets in the rest. So texts that share no more than a
       passage hardly ever meet under it. Those that a single class has are dropped,
       so texts unlike all others post nothing and frequent values are hardly ever posted. Two unlike texts
       seldom have all values of a span by chance, so lists do not grow with the number of documents.
    3. Within a posting list all are compared with its hub, the class whose pairs are shared most
       (the original, where the others are copies of it). What is linked is one cluster, and lists
       with a single cluster are done. In open lists of at most ``compared`` members all pairs of different clusters are
       compared by sketches of their signatures, which seldom leaves a pair of unlike texts. Larger open lists whose hubs are of one cluster are a group with one
       of these hubs. Of every member only the difference from that hub counts: the
       shingles it lacks and those it adds. Two members that are linked, but not both with the hub, share at least as many
       differences as their numbers of them tell, so each is posted under its rarest ones, as
       many as such a partner cannot all lack, and compared where it meets one. Independent near
       copies of a text share none of their rare differences and never meet, however many they are.
    4. A pair is counted over its coordinates and by its sets' parities, which bound their difference from
       below, and confirmed on the full sets. Only the texts this takes are fetched.
    """
    work = Work(df.sparkSession)
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    signed = work.store(signatures(rows, "text", settings).drop("text"), "signatures")
    sets = F.struct("set_key", "signature", "sketch", "parity", F.col("n_shingles").alias("n"))
    single = signed.where("key is not null and set_key is not null").groupBy("key")
    single = single.agg(F.min_by(sets, "set_key").alias("one")).select("key", "one.*")
    classes = single.groupBy("set_key").agg(
        F.min("key").alias("id"), *(F.first(c).alias(c) for c in ("signature", "sketch", "parity", "n"))
    )
    classes = work.store(classes, "classes")
    posted = work.store(postings(classes, settings), "postings")
    work.release()
    links = work.store(confirmed(star_pairs(posted), classes, rows, settings, work), "links")
    work.release()
    clusters = components(links, work)
    lists = work.store(open_lists(posted, clusters), "lists")
    work.drop(posted)
    work.release()
    links = links.unionByName(confirmed(sketched_pairs(lists, classes, settings), classes, rows, settings, work))
    links = work.store(links, "links")
    work.release()
    opened = work.store(open_groups(lists.where(F.col("members") > settings.compared)), "open")
    work.drop(lists)
    work.release()
    repeated = not signed.groupBy("key").count().where("count > 1").isEmpty()
    differences = work.store(from_hub(opened, classes, rows, settings, repeated, work), "differences")
    work.release()
    near = differences.where("linked and cluster <> grp").select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b"))
    pairs = work.store(difference_pairs(differences, settings, work).unionByName(near).distinct(), "pairs")
    work.drop(differences)
    work.release()
    found = confirmed(pairs, classes, rows, settings, work, signed=False)
    links = work.store(links.unionByName(found), "links")
    work.release()
    found = components(links, work)
    ids = classes.select("set_key", "id").join(found, F.col("id") == F.col("node"), "left")
    ids = ids.select("set_key", F.coalesce("component", "id").alias("component_id"))
    own = signed.where("key is not null and set_key is not null").groupBy("key").agg(F.min("set_key").alias("set_key"))
    ids = own.join(ids, "set_key").drop("set_key")
    result = signed.join(ids, "key", "left")
    component = F.coalesce("component_id", "key")
    return result.select(
        F.col("key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )


def span_width(settings: Settings) -> int:
    """Neighbouring coordinates of a span: the most with which signatures of ``least_matches`` equal
    coordinates have a span equal as a whole, two at most, as these fill a long."""
    return 2 if equal_spans(settings, 2) > 0 else 1


def equal_spans(settings: Settings, width: int) -> int:
    """Spans that signatures of ``least_matches`` equal coordinates have equal as a whole, at least.
    A last span is shorter if the coordinates do not divide."""
    spans = -(-settings.coordinates // width)
    return settings.least_matches - (settings.coordinates - spans)


def shared_spans(settings: Settings, width: int) -> int:
    """Spans that a similar pair has equal as a whole, at least, with all but a likelihood of 5e-7: what
    ``equal_spans`` says of the least number of equal coordinates is far from what they come to."""
    spans, equal = -(-settings.coordinates // width), (settings.percent / 100) ** width
    fewer, least = 0.0, 0
    while (fewer := fewer + comb(spans, least) * equal**least * (1 - equal) ** (spans - least)) < 5e-7:
        least += 1
    return max(least, equal_spans(settings, width))


def postings(classes: DataFrame, settings: Settings) -> DataFrame:
    """(list, id, shared): each class under its rarest spans of coordinates whose values others have
    too, and how often its spans are shared in all."""
    width = span_width(settings)
    spans, values = -(-settings.coordinates // width), F.col("signature")
    if width == 2:
        # Two 32-bit values side by side; after the last of an odd number of coordinates comes 0.
        low = lambda i: F.coalesce(F.get("signature", i * 2 + 1), F.lit(0)).cast("long").bitwiseAND(0xFFFFFFFF)
        pair = lambda i: F.shiftleft(F.get("signature", i * 2).cast("long"), 32).bitwiseOR(low(i))
        values = F.transform(F.sequence(F.lit(0), F.lit(spans - 1)), pair)
    pairs = classes.select("id", F.posexplode(values).alias("span", "value"))
    shared = pairs.groupBy("span", "value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    met = pairs.join(shared, ["span", "value"])
    # A class has so many `spans`; those that nobody shares are rarer than all of `met`.
    own = Window.partitionBy("id")
    alone = spans - F.count(F.lit(1)).over(own)
    rarest = F.row_number().over(Window.partitionBy("id").orderBy("df", "span"))
    prefix = spans - shared_spans(settings, width) + 1
    shown = F.sum("df").over(own).alias("shared")
    ranked = met.select("id", shown, "span", "value", (rarest + alone).alias("place"))
    listed = ranked.where(F.col("place") <= prefix)
    return listed.select(F.struct("span", "value").alias("list"), "id", "shared")


def star_pairs(posted: DataFrame) -> DataFrame:
    """Every member of a list with the list's hub, the member whose pairs are shared most."""
    hubs = posted.groupBy("list").agg(F.max_by("id", F.struct("shared", "id")).alias("hub"))
    pairs = posted.join(hubs, "list").where("id <> hub")
    return pairs.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b"))


def open_lists(posted: DataFrame, clusters: DataFrame) -> DataFrame:
    """(list, id, cluster, members, hub, grp): the members of lists of three or more that hold several clusters, how
    many these are, the list's hub and its cluster."""
    placed = posted.join(clusters, F.col("id") == F.col("node"), "left")
    placed = placed.select("list", "id", "shared", F.coalesce("component", "id").alias("cluster"))
    lists = placed.groupBy("list").agg(
        F.max_by(F.struct("id", "cluster"), F.struct("shared", "id")).alias("hub"),
        F.count(F.lit(1)).alias("members"),
        (F.min("cluster") < F.max("cluster")).alias("open"),
    )
    # A list of two has no pair but that with its hub, which has been compared.
    lists = lists.where("open and members > 2").select("list", "members", F.col("hub.id").alias("hub"), F.col("hub.cluster").alias("grp"))
    return placed.select("list", "id", "cluster").join(lists, "list")


def sketched_pairs(lists: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): pairs within lists of at most ``compared`` members, in different clusters and not with the hub, whose
    sketches have ``least_matches`` coordinates that may be equal. A member meets a bounded number of others a list."""
    few = lists.where((F.col("members") <= settings.compared) & (F.col("id") != F.col("hub")))
    few = few.select("list", "id", "cluster").join(classes.select("id", "sketch"), "id")
    a = few.select("list", F.col("id").alias("a"), F.col("cluster").alias("ca"), F.col("sketch").alias("sa"))
    b = few.select("list", F.col("id").alias("b"), F.col("cluster").alias("cb"), F.col("sketch").alias("sb"))
    differ = F.lit(0)
    for word in range(-(-settings.coordinates // 64)):
        places = [F.get("sa", F.lit(i)).bitwiseXOR(F.get("sb", F.lit(i))) for i in range(word * SKETCHED, (word + 1) * SKETCHED)]
        differ += F.bit_count(reduce(Column.bitwiseOR, places))
    near = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (differ <= settings.coordinates - settings.least_matches)
    return a.join(b, "list").where(near).select("a", "b").distinct()


def open_groups(lists: DataFrame) -> DataFrame:
    """(grp, hub, id, cluster): the members of these open lists. Lists whose hubs
    are of one cluster are one group, with the hub of its longest list."""
    hubs = lists.groupBy("grp").agg(F.max_by("hub", F.struct("members", "hub")).alias("hub"))
    return lists.select("grp", "id", "cluster").distinct().join(hubs, "grp")


def from_hub(opened: DataFrame, classes: DataFrame, rows: DataFrame, settings: Settings, repeated: bool, work: Work) -> DataFrame:
    """(grp, hub, id, cluster, n, v, linked, lacks, adds): a member's difference from its hub.

    ``lacks`` and ``adds`` are the m shingles it lacks and the a it adds, as 32 bits of their hashes,
    n the hub's shingles, and ``v`` = 2 (100 m + percent a) - (100 - percent) n. Members x and y are
    similar enough if they share s differences with 2 (100 + percent) s >= v(x) + v(y), and one is
    linked with its hub if v <= (100 - percent) n. Two hashes that agree by chance may hide a
    difference, so what is found here is confirmed on the full sets.
    """
    percent = settings.percent
    kind = opened.schema["id"].dataType.simpleString()
    keys = classes.select("id", F.col("set_key").alias("wanted"))

    groups = opened.groupBy("id").agg(F.collect_list(F.struct("grp", "hub", "cluster")).alias("groups"))
    hubs = opened.select(F.col("hub").alias("id")).distinct()
    needed = work.store(groups.select("id").unionByName(hubs).distinct().join(keys, "id"), "needed")
    texts = texts_of(rows, needed.select(F.col("id").alias("key")), settings)
    sets = shingle_sets(texts, "text", settings, narrow=True).withColumnRenamed("key", "id")
    sets = sets.join(needed, "id").where("set_key = wanted").select("id", "shingles")
    if repeated:  # rows of one key with one text
        sets = sets.dropDuplicates(["id"])
    sets = work.store(sets, "sets")
    own = sets.join(groups, "id").select("id", F.inline("groups"), F.col("shingles").alias("x"))
    hubs = sets.join(hubs, "id").select(F.col("id").alias("hub"), F.col("shingles").alias("h"))
    met = own.where("id <> hub").join(hubs, "hub")
    names = ["n", "v", "linked", "lacks", "adds"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for x, h in zip(batch.column("x"), batch.column("h")):
                x, h = (np.frombuffer(side.as_buffer(), np.uint32) for side in (x, h))
                lacks, adds = np.setdiff1d(h, x, assume_unique=True), np.setdiff1d(x, h, assume_unique=True)
                v = 2 * (100 * len(lacks) + percent * len(adds)) - (100 - percent) * len(h)
                made.append((len(h), v, v <= (100 - percent) * len(h), lacks.view(np.int32), adds.view(np.int32)))
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            arrays = [pa.array(c, t) for c, t in zip(zip(*made), types)] or [pa.array([], t) for t in types]
            passed = ["grp", "hub", "id", "cluster"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in passed), *arrays], [*passed, *names])

    ddl = f"grp {kind}, hub {kind}, id {kind}, cluster {kind}, n bigint, v bigint, linked boolean, lacks array<int>, adds array<int>"
    return met.select("grp", "hub", "id", "cluster", "x", "h").mapInArrow(run, ddl)


def difference_pairs(differences: DataFrame, settings: Settings, work: Work) -> DataFrame:
    """(a, b): pairs of a group in different clusters that may be similar, at least one of them
    not linked with the hub.

    Say x has the larger v of a pair. For y it lies in one of a few bands of v, each with a least
    number of shared elements; y is posted in each band under its rarest elements, as many as a
    partner of the band that shares so many cannot all lack. x looks up its own band with
    as many of its rarest elements as any partner asks for. Elements whose members are of one cluster,
    or all linked with the hub, bring no such pair together: they come before all others and are not posted.
    """
    percent = settings.percent
    unit, gap = 2 * (100 + percent), 100 - percent
    size = (F.size("lacks") + F.size("adds")).cast("long")
    own = differences.withColumns({"size": size, "limit": F.col("n") * gap}).where("size > 0")
    tagged = F.concat(F.transform("lacks", lambda e: e.cast("long") * 2), F.transform("adds", lambda e: e.cast("long") * 2 + 1))
    listed = own.select("grp", "id", "cluster", "v", "size", "limit", "linked", F.explode(tagged).alias("element"))
    listed = work.store(listed, "listed")
    shared = listed.groupBy("grp", "element").agg(
        F.count(F.lit(1)).alias("df"), (F.min("cluster") < F.max("cluster")).alias("apart"), F.min("linked").alias("linked")
    )
    met = listed.join(shared.where("apart and not linked").select("grp", "element", "df"), ["grp", "element"])
    mine = Window.partitionBy("grp", "id")
    alone = F.col("size") - F.count(F.lit(1)).over(mine)
    rarest = F.row_number().over(Window.partitionBy("grp", "id").orderBy("df", "element"))
    ranked = work.store(met.withColumn("place", alone + rarest).drop("df"), "ranked")
    width = F.greatest(F.floor(F.col("limit") / 2), F.lit(1))

    def least(v: Column) -> Column:
        """Shared elements of a pair with this sum of v, at least."""
        return F.greatest(F.ceil(v / unit), F.lit(1))

    first = F.floor((F.col("limit") + 1) / width)
    last = F.floor((F.col("size") * unit - F.col("v")) / width)
    from_band = F.greatest(first, F.floor(F.col("v") / width))
    bands = F.when(last >= from_band, F.sequence(from_band, last))
    posted = ranked.select("*", width.alias("width"), F.explode(bands).alias("band"))
    low = F.greatest(F.col("band") * F.col("width"), F.col("limit") + 1)
    posted = posted.where(F.col("place") <= F.col("size") - least(low + F.col("v")) + 1)
    posted = posted.select("grp", "band", "element", F.col("id").alias("y"), F.col("cluster").alias("cy"), F.col("v").alias("vy"))
    probes = ranked.where(~F.col("linked") & (F.col("place") <= F.col("size") - least(F.col("v") - F.col("limit")) + 1))
    probes = probes.select("grp", F.floor(F.col("v") / width).alias("band"), "element", F.col("id").alias("x"), F.col("cluster").alias("cx"), F.col("v").alias("vx"))
    pairs = probes.join(posted, ["grp", "band", "element"]).where("x <> y and cx <> cy and vy <= vx")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def confirmed(
    pairs: DataFrame, classes: DataFrame, rows: DataFrame, settings: Settings, work: Work, signed: bool = True
) -> DataFrame:
    """Pairs whose full sets are similar enough; ``signed``: and whose signatures match often enough.

    Sets are worked out for pairs only whose parities allow for it. Similar enough are sets that differ in
    d shingles with (100 + percent) d <= (100 - percent) (n(a) + n(b)), and d is no less than the bits their
    parities differ in, so no pair is lost by that.
    """
    percent = settings.percent
    sides = classes.select("id", "n", "parity", *(["signature"] if signed else []))
    a = sides.select(*(F.col(c).alias({"id": "a"}.get(c, f"{c}_a")) for c in sides.columns))
    b = sides.select(*(F.col(c).alias({"id": "b"}.get(c, f"{c}_b")) for c in sides.columns))
    met = pairs.distinct().join(a, "a").join(b, "b")
    met = met.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    if signed:
        equal = F.aggregate(
            F.zip_with("signature_a", "signature_b", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x
        )
        met = met.where(equal >= settings.least_matches)
    bits = F.aggregate(
        F.zip_with("parity_a", "parity_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    met = met.where(bits * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
    likely = work.store(met.select("a", "b"), "pairs")
    return _similar(likely, full_sets(likely, classes, rows, settings), percent)


def texts_of(rows: DataFrame, needed: DataFrame, settings: Settings) -> DataFrame:
    """The rows with the keys of ``needed``. Unless these are very many, all tasks get them, so that the
    other texts are read but not shuffled."""
    few = needed.count() <= settings.sent
    return rows.join(F.broadcast(needed) if few else needed, "key", "left_semi")


def full_sets(pairs: DataFrame, classes: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """(key, shingles) of every class in ``pairs``."""
    needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    # Of a repeated key only the row that its class was made from counts.
    full = shingle_sets(texts_of(rows, needed, settings), "text", settings).drop("text")
    sets = classes.select("set_key", F.col("id").alias("key")).join(full, ["key", "set_key"])
    return sets.dropDuplicates(["key"])


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    own = sets.select("key", "shingles")
    joined = pairs.join(own.select(F.col("key").alias("a"), F.col("shingles").alias("xa")), "a")
    joined = joined.join(own.select(F.col("key").alias("b"), F.col("shingles").alias("xb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                p = np.frombuffer(x.as_buffer(), np.uint64)
                q = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return joined.select("a", "b", "xa", "xb").mapInArrow(run, f"a {kind}, b {kind}")
