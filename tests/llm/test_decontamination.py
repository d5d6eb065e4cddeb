import hashlib
import random

import pytest
from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import queries
from stayflow.llm.decontamination import decontaminate


def words_of(text):
    out, word = [], ""
    for c in [*(text or ""), " "]:
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        found = words_of(text)
        for i in range(max(1, len(found) - size + 1) if found and item is not None else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        found, hit, ids = words_of(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(found) - len(window) + 1):
                if tuple(found[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    ids |= owners
        out.append((doc, len(found), len(hit), sorted(ids)))
    return sorted(out, key=str)


def tables(seed):
    rng = random.Random(seed)
    vocabulary = ["ab", "a", "b", "Ab", "É", "é", "日本", "x1", "a_b", "K", "K"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "-", "\n", ". ", "!"]) for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(30)] + [(3, text(12)), (None, text(12)), (40, None)]
    docs = []
    for i in range(120):
        parts = [text(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(items)[1] or ""
            at = rng.randrange(len(passage) // 2 + 1)
            parts += [passage[at:].upper() if rng.random() < 0.3 else passage[at:], text(rng.randrange(5))]
        docs.append((i, " ".join(parts)))
    return [*docs, (7, "ab"), (900, None), (901, "")], items


@pytest.mark.parametrize("chars, size", [(4_000_000, 10), (300, 10), (4_000_000, 3)])
def test_equals_brute_force(spark, chars, size):
    """With one automaton and, where windows are more than it takes, with several."""
    docs, items = tables(size)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate(narrow(spark, docs), asked, words=size, automaton_chars=chars).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=str) == brute(docs, items, size)
    for r in found:
        spans = [(s.start, s.end) for s in r.spans]
        assert sum(len(words_of(r.text[a:b])) for a, b in spans) == r.n_hit
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_spans_and_parts(spark):
    docs = narrow(spark, [(1, "É: What,  is IT? (that)"), (2, "is it"), (3, "what is")])
    items = spark.createDataFrame([("q1", "what is it", "that"), ("q2", None, "É")], "id string, question string, answer string")
    rows = decontaminate(docs, items, key="id", parts=("question", "answer"), words=3).orderBy("doc_id").collect()
    assert [r.text[s.start : s.end] for r in rows for s in r.spans] == ["É: What,  is IT? (that"]
    assert [r["items"] for r in rows] == [["q1", "q2"], [], []]


def test_query_on_own_tables(spark, tmp_path):
    docs, items = tables(5)
    narrow(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.QUERIES["op12_decontamination"](spark, str(tmp_path)).collect()
    expected = [
        (d, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0) for d, n, hit, ids in brute(docs, items, 10)
    ]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_edge_rows(spark):
    df = edge_rows(spark)
    items = spark.createDataFrame([(1, "w5x5"), (2, "A b C"), (3, None)], "item_id bigint, text string")
    rows = decontaminate(df, items).collect()
    assert len(rows) == df.count() and all(r.key == "own" for r in rows)
    assert [r["items"] for r in rows if r.text == "a b c d e f g"] == [["2"], ["2"]]
    assert [(r.n_words, r.n_hit, r.spans, r["items"]) for r in rows if not r.text] == [(0, 0, [], [])] * 3
    assert all(r.n_hit == 0 for r in decontaminate(df, items.limit(0)).collect())
    assert decontaminate(narrow(spark, []), items).collect() == []
