import math
import random
from collections import Counter

import pytest
from rows_at_the_edge import edge_rows, narrow
from test_decontamination import words_of

from stayflow.llm import lexical_search, queries
from stayflow.llm.lexical_search import search
from stayflow.llm.shared_sums import plan_sums


def brute(docs, items, k):
    tf = [(d, Counter(words_of(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, c in tf if c), sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, Counter()).update(words_of(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, counts in tf:
            m = 25 + (75 * counts.total() * n_docs) // n_terms
            score = 0
            for t, times in terms.items():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += times * w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m)) if counts[t] else 0
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def tables(seed):
    rng = random.Random(seed)
    words = [f"w{int(40 * rng.random() ** 3)}" for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    docs = [(i, text(rng.randrange(60))) for i in range(700)]
    docs += [(i + 1000, docs[i % 3][1]) for i in range(40)] + [(5, text(9)), (None, text(9)), (3000, None), (3001, "…")]
    items = [(i, text(rng.randrange(25))) for i in range(25)] + [(3, text(9)), (70, "unheard"), (71, None), (None, text(4))]
    return docs, items


@pytest.mark.parametrize("block", [200_000, 200])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lexical_search.Best, "SLACK", 1)
    docs, items = tables(block)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    found = search(narrow(spark, docs).repartition(3), asked, k=10, block_chars=block).collect()
    assert sorted(map(tuple, found)) == brute(docs, items, 10)


def test_query_on_own_tables(spark, tmp_path):
    docs, items = tables(4)
    narrow(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.QUERIES["op13_lexical_search"](spark, str(tmp_path))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(docs, items, 10)


def test_shared_sums_are_exact_and_fewer():
    rng = random.Random(2)
    common = [rng.sample(range(60), 12) for _ in range(3)]
    sets = [sorted({*rng.choice(common), *rng.sample(range(200), rng.randrange(9))}) for _ in range(50)] + [[], [7]]
    plan = plan_sums(sets, 200)

    def leaves(node):
        if node < plan.n_leaves:
            return [node]
        return [x for part in plan.nodes[node - plan.n_leaves] for x in leaves(part)]

    assert [sorted(x for part in s for x in leaves(part)) for s in plan.sums] == sets
    assert all(max(pair) < plan.n_leaves + i for i, pair in enumerate(plan.nodes))
    assert plan.additions < 0.5 * sum(max(0, len(s) - 1) for s in sets)


def test_edge_rows(spark):
    df = edge_rows(spark)
    items = spark.createDataFrame([("i", "one a w5x5"), ("j", "nothing")], "item_id string, text string")
    rows = search(df, items, k=3).collect()
    assert [r.item_id for r in rows] == ["i"] * 3 and {r["rank"] for r in rows} == {1, 2, 3}
    assert search(narrow(spark, []), items).collect() == [] and search(df, items.limit(0)).collect() == []
    assert search(narrow(spark, [(1, None), (2, "")]), items).collect() == []
