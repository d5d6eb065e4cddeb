"""Ranked lexical search of many items at once: parts that items share are scored once."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.rows import Work
from stayflow.llm.shared_sums import Plan, plan_sums
from stayflow.llm.words import word_bytes

# Characters of items that are searched for in one pass over the documents.
BLOCK_CHARS = 200_000
# Documents scored together, fewer where their values would take more numbers than that.
DOCUMENTS_AT_ONCE, NUMBERS_AT_ONCE = 256, 8_000_000


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc: str = "doc_id", item: str = "item_id", text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(item, rank, doc, score): the ``k`` best documents of each item with a score above 0.

    Terms are stretches of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. A
    term's weight falls with the number of documents that have it, its score in a document rises
    with its occurrences there and falls with the document's length; an item's score is the sum over its terms,
    repeats included, in whole numbers. Equal scores go by document key, an integer.

    Each block of items takes two passes over all documents. The first counts the terms of the
    block in each whole text and stores them with the document's length; every task adds up its
    own document frequencies. The second scores: sets of terms that several items share
    (``plan_sums``) are added up once for a batch of documents, and items are put together from
    these along the graph. A task keeps the ``k`` best of each item, and these meet at the end.

    Null and empty texts have no terms. Documents with a null key count in the statistics and are
    not ranked; null items are left out, repeated item keys are one item with all their
    terms; documents of a repeated key are ranked each for itself. Other columns are ignored.
    """
    work = Work(docs.sparkSession)
    rows = docs.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))
    asked = items.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("text"))
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    found = []
    for n in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n).toArrow()
        queries = Queries.of(block.column("item").to_pylist(), block.column("text").to_pylist())
        if queries.items:
            found.append(_best(rows, queries, k, work))
    kind = items.schema[item].dataType.simpleString()
    schema = f"item {kind}, rank int, doc bigint, score bigint"
    result = docs.sparkSession.createDataFrame([], schema)
    for (place, queries) in found:
        names = docs.sparkSession.createDataFrame(list(enumerate(queries.items)), f"n int, item {kind}")
        result = result.unionByName(place.join(F.broadcast(names), "n").select("item", "rank", "doc", "score"))
    return result.select(F.col("item").alias(item), "rank", F.col("doc").alias(doc), "score")


@dataclass(frozen=True)
class Queries:
    """A block's items: their terms by number, and each item's terms with their counts."""

    items: list
    terms: dict[bytes, int]
    counts: list[dict[int, int]]

    @staticmethod
    def of(items: list, texts: list[str | None]) -> Queries:
        merged: dict = {}
        for item, text in zip(items, texts):
            merged.setdefault(item, Counter()).update(word_bytes(text))
        names = sorted(merged)
        terms: dict[bytes, int] = {}
        counts = [{terms.setdefault(t, len(terms)): n for t, n in merged[name].items()} for name in names]
        return Queries(names, terms, counts)


def _best(rows: DataFrame, queries: Queries, k: int, work: Work) -> tuple[DataFrame, Queries]:
    counted = work.store(_counted(rows, queries.terms), "terms")
    totals = counted.where("stats").agg(F.sum("n").alias("terms"), F.sum("doc").alias("docs")).first()
    frequency = counted.where("stats").select(F.posexplode("counts").alias("term", "n"))
    of_term = [0] * len(queries.terms)
    for row in frequency.groupBy("term").agg(F.sum("n").alias("n")).collect():  # no more than the block's terms
        of_term[row.term] = row.n
    n_docs, n_terms = totals.docs or 0, totals.terms or 0
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in of_term]
    best = _ranked(counted.where("not stats").select("doc", "n", "terms", "counts"), queries, weights, n_docs, n_terms, k)
    # Tasks send k rows an item; a first cut by groups of tasks keeps an item's last sort small.
    order = [F.col("score").desc(), F.col("doc")]
    place = F.row_number().over(Window.partitionBy("n", "task").orderBy(*order))
    best = best.withColumn("rank", place).where(F.col("rank") <= k)
    place = F.row_number().over(Window.partitionBy("n").orderBy(*order))
    best = best.withColumn("rank", place).where(F.col("rank") <= k)
    return best.select("n", "rank", "doc", "score"), queries


def _counted(rows: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(stats, doc, n, terms, counts): a document's length and the block's terms in it; and with
    ``stats`` a row for each task: its documents, their terms, and how many have each term."""
    shared = rows.sparkSession.sparkContext.broadcast(terms)
    names = ["stats", "doc", "n", "terms", "counts"]
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        frequency, n_docs, n_terms = np.zeros(len(shared.value), np.int64), 0, 0
        for batch in batches:
            made = []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                words = word_bytes(text)
                if not words:
                    continue
                n_docs += 1
                n_terms += len(words)
                known = [t for t in map(number, words) if t is not None]
                if not known:
                    continue
                found, counts = np.unique(np.array(known, np.int32), return_counts=True)
                frequency[found] += 1
                if doc is not None:
                    made.append((False, doc, len(words), found, counts))
            if made:
                columns = [pa.array(c, t) for c, t in zip(zip(*made), (pa.bool_(), pa.int64(), pa.int64(), ints, longs))]
                yield pa.RecordBatch.from_arrays(columns, names)
        columns = [[True], [n_docs], [n_terms], [None], [frequency]]
        types = (pa.bool_(), pa.int64(), pa.int64(), ints, longs)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return rows.mapInArrow(run, "stats boolean, doc bigint, n bigint, terms array<int>, counts array<bigint>")


def _ranked(
    counted: DataFrame, queries: Queries, weights: list[int], n_docs: int, n_terms: int, k: int
) -> DataFrame:
    """(n, task, doc, score): of each task the ``k`` best documents of each item."""
    sets, leaves = _leaves(queries, weights)
    plan = plan_sums(sets, len(leaves))
    leaves = np.array(leaves, np.int64).reshape(-1, 2)
    shared = counted.sparkSession.sparkContext.broadcast((plan, leaves, np.array(weights, np.int64)))
    at_once = max(1, min(DOCUMENTS_AT_ONCE, NUMBERS_AT_ONCE // (len(weights) + 2 * len(leaves) + len(plan.nodes) + 1)))
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, leaves, weight = shared.value
        score = scorer(token, lambda: Sums(plan))
        best = Best(len(plan.sums), k)
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                doc = part.column("doc").to_numpy()
                n = part.column("n").to_numpy().astype(np.int64)
                length = 25 + (75 * n * n_docs) // n_terms
                listed, counts = part.column("terms"), part.column("counts")
                term, tf = (x.flatten().to_numpy() for x in (listed, counts))
                row = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(listed).to_numpy())
                value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length[row]))
                of_term = np.zeros((len(weight), part.num_rows), np.int64)
                of_term[term, row] = value
                best.add(doc, score(of_term[leaves[:, 0]] * leaves[:, 1:]))
        n, doc, found = best.rows()
        if len(n):
            task = np.full(len(n), hash(int(doc[0])) % 64, np.int32)
            columns = [pa.array(n.astype(np.int32)), pa.array(task), pa.array(doc), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, ["n", "task", "doc", "score"])

    return counted.mapInArrow(run, "n int, task int, doc bigint, score bigint")


def _leaves(queries: Queries, weights: list[int]) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Each item's leaves, and the (term, times) of every leaf. Where items repeat a term unequally
    often, what the fewer repeats are worth is a leaf of all, and what the next ones add is another."""
    steps: dict[int, set[int]] = {}
    for counts in queries.counts:
        for term, n in counts.items():
            steps.setdefault(term, set()).add(n)
    number: dict[tuple[int, int], int] = {}
    leaves = []
    for term in sorted(t for t in steps if weights[t]):
        below = 0
        for n in sorted(steps[term]):
            number[term, n] = len(leaves)
            leaves.append((term, n - below))
            below = n
    sets = [
        [number[t, n] for t, count in sorted(counts.items()) if weights[t] for n in sorted(steps[t]) if n <= count]
        for counts in queries.counts
    ]
    return sets, leaves


class Sums:
    """Works a plan out for a batch: every row of ``values`` is a leaf, every column a document."""

    def __init__(self, plan: Plan) -> None:
        self.plan = plan

    def __call__(self, values: np.ndarray) -> np.ndarray:
        plan = self.plan
        made = np.empty((plan.n_leaves + len(plan.nodes), values.shape[1]), np.int64)
        made[: plan.n_leaves] = values
        for i, (a, b) in enumerate(plan.nodes, plan.n_leaves):
            np.add(made[a], made[b], out=made[i])
        out = np.zeros((len(plan.sums), values.shape[1]), np.int64)
        for i, parts in enumerate(plan.sums):
            if parts:
                np.sum(made[parts], axis=0, out=out[i])
        return out


_SCORERS: dict[str, Callable] = {}


def scorer(token: str, build: Callable[[], Callable]) -> Callable:
    if token not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[token] = build()
    return _SCORERS[token]


class Best:
    """The ``k`` best documents of each item so far, equal scores by document."""

    SLACK = 20  # times k rows an item may wait for the next cut

    def __init__(self, items: int, k: int) -> None:
        self.items, self.k = items, k
        self.least = np.ones(items, np.int64)  # scores below this cannot get in any more
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        item, column = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        self.parts.append((item, docs[column], scores[item, column]))
        self.waiting += len(item)
        if self.waiting > self.SLACK * self.k * self.items:
            self.cut()

    def cut(self) -> None:
        item, doc, score = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        starts = np.searchsorted(item, np.arange(self.items))
        place = np.arange(len(item)) - starts[item]
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        kept = place < self.k
        self.parts = [(item[kept], doc[kept], score[kept])]
        self.waiting = int(kept.sum())

    def rows(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        self.cut()
        return self.parts[0]
