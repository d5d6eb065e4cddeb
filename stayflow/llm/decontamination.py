"""Passages of test items in texts, found by one Aho-Corasick automaton."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.rows import Work, add_columns, free_name
from stayflow.llm.words import word_bytes, word_spans

# Characters of windows (with eight for each item that has one) that one automaton takes.
AUTOMATON_CHARS = 4_000_000


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "item_id",
    parts: Sequence[str] = ("text",),
    text: str = "text",
    words: int = 10,
    automaton_chars: int = AUTOMATON_CHARS,
) -> DataFrame:
    """``docs`` with n_words, n_hit, spans and items.

    Words are stretches of ASCII letters, digits and characters beyond ASCII, A-Z in lower
    case. ``parts`` are an item's texts (question and answer, say). A window is ``words`` consecutive words of a part; a part of
    fewer words, but not none, is one window. A word of a document inside any occurrence of a
    window is hit. ``spans`` are the maximal stretches of hit words as (start, end) in code points of
    the text as it was, the end exclusive; ``items`` the ids of items with occurring windows, as sorted text.

    The windows of all items go into one automaton that sees each text once. Beyond
    ``automaton_chars`` windows are dealt by hash into as many automata as that asks for, with one
    pass each; what is sent to the workers is never larger than about that. No shuffle of the documents.

    Null and empty texts have no words. Items with a null id are left out, null parts
    have no window, parts of a repeated id belong to one item. Without items nothing is hit.
    Repeated documents are judged each for itself. Columns of the new names are replaced.
    """
    work = Work(docs.sparkSession)
    windows = work.store(_windows(items, key, parts, words), "windows")
    chars = windows.agg(F.sum(F.char_length("window") + 8)).first()[0] or 0
    passes = max(1, -(-chars // automaton_chars))
    deal = F.pmod(F.xxhash64("window", "item"), F.lit(passes))
    for n in range(passes):
        found = windows.where(deal == n).select("window", "item").toArrow()
        docs = _scanned(docs, text, found.column("window").to_pylist(), found.column("item").to_pylist(), first=n == 0)
        if passes > 1:
            docs = work.store(docs, "scanned")
    return docs


def _windows(items: DataFrame, key: str, parts: Sequence[str], words: int) -> DataFrame:
    """(window, item) without repeats: the words of each window, parted and enclosed by blanks."""
    texts = F.explode(F.array(*[F.col(p) for p in parts])).alias("text")
    rows = items.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("item"), texts)

    def make():
        def work(value):
            found = [w.decode() for w in word_bytes(value)]
            if not found:
                return ([],)
            starts = range(max(1, len(found) - words + 1))
            return (list(dict.fromkeys(f" {' '.join(found[i : i + words])} " for i in starts)),)

        return work

    made = add_columns(rows, "text", "windows array<string>", make)
    return made.select("item", F.explode("windows").alias("window")).distinct()


def _scanned(docs: DataFrame, text: str, windows: list[str], items: list[str], first: bool) -> DataFrame:
    """The documents after one automaton's pass; ``spans`` and ``items`` of earlier passes are added to."""
    of_window: dict[str, list[str]] = {}
    for window, item in zip(windows, items):
        of_window.setdefault(window, []).append(item)
    shared, token = docs.sparkSession.sparkContext.broadcast(of_window), uuid.uuid4().hex
    schema = "n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"

    def load():
        return scanner(token, lambda: shared.value)

    if first:

        def make():
            scan = load()
            return lambda value: scan(value, [], [])

        return add_columns(docs, text, schema, make)

    def make_more():
        scan = load()
        return lambda value: scan(value["text"], value["spans"], value["items"])

    given = free_name(docs, "given")
    packed = docs.withColumn(given, F.struct(F.col(text).alias("text"), "spans", "items"))
    return add_columns(packed, given, schema, make_more).drop(given)


_SCANNERS: dict[str, Callable] = {}


def scanner(token: str, load: Callable[[], dict[str, list[str]]]) -> Callable:
    """A worker's scanner; the automaton of the latest token is kept for the next task."""
    if token not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[token] = _build(load())
    return _SCANNERS[token]


def _build(of_window: dict[str, list[str]]) -> Callable:
    automaton = ahocorasick.Automaton()
    for n, window in enumerate(of_window):
        automaton.add_word(window, (n, window.count(" ") - 1))
    automaton.make_automaton()
    items = list(of_window.values())

    def scan(text, spans, known):
        found = word_bytes(text)
        if not found:
            return 0, 0, [], []
        line = b" " + b" ".join(found) + b" "
        matches = list(automaton.iter(line.decode())) if of_window else []
        if not matches and not spans:
            return len(found), 0, [], known
        places = word_spans(text)
        marks = np.zeros(len(found) + 1, np.int64)
        if matches:
            # A match ends at the blank after its last word: count the blanks up to there.
            ends = np.fromiter((end for end, _ in matches), np.int64, len(matches))
            lengths = np.fromiter((n for _, (_, n) in matches), np.int64, len(matches))
            blanks = np.cumsum(np.array([0] + [b - a + 1 for a, b in places]))
            last = np.searchsorted(blanks, ends)
            np.add.at(marks, last - lengths, 1)
            np.add.at(marks, last, -1)
        if spans:
            starts, stops = [a for a, _ in places], [b for _, b in places]
            np.add.at(marks, np.searchsorted(starts, [s["start"] for s in spans]), 1)
            np.add.at(marks, np.searchsorted(stops, [s["end"] for s in spans]) + 1, -1)
        hit = np.cumsum(marks[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
        runs = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2], edges[1::2])]
        ids = set(known)
        for n in {n for _, (n, _) in matches}:
            ids.update(items[n])
        return len(found), int(hit.sum()), runs, sorted(ids)

    return scan
