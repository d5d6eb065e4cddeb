import random

import numpy as np
import pytest
from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import mixing
from stayflow.llm.mixing import Settings


def corpus(spark):
    rng, rows, labels = random.Random(6), [], []
    for i in range(400):
        name = "ab"[i % 4 == 0]
        own = [f"{name}{rng.randrange(30)}" for _ in range(rng.randrange(10, 40))]
        rows.append((i, " ".join(own + [f"c{rng.randrange(50)}" for _ in range(20)])))
        if i % 2 == 0:
            labels.append((i, name))
    return narrow(spark, rows), spark.createDataFrame(labels, "doc_id bigint, domain string")


def totals(rows, names):
    return {n: sum(r.n_tokens * r.rate * r.domains[n] for r in rows) for n in names}


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.5}, {"a": 1.0, "b": 3.0}])
def test_expected_tokens_match_targets(spark, weights):
    docs, labels = corpus(spark)
    rows = mixing.mix(docs, labels, weights).collect()
    assert len(rows) == 400 and min(r.rate for r in rows) >= 0
    got, whole = totals(rows, "ab"), sum(r.n_tokens for r in rows)
    for name, weight in weights.items():
        assert got[name] == pytest.approx(whole * weight / sum(weights.values()), rel=0.01)
    right = sum((r.domains["b"] > 0.5) == (r.doc_id % 4 == 0) for r in rows)
    assert right == 400 and all(sum(r.domains.values()) == pytest.approx(1) for r in rows)


def test_keeping_all_and_repeating(spark):
    docs, labels = corpus(spark)
    rates = mixing.mix(docs, labels, {"a": 1.0, "b": 1.0}, settings=Settings(keep_all=True))
    rows = mixing.repeat_by_rate(docs, rates).collect()
    by_id = {r.doc_id: r.rate for r in rates.collect()}
    counts = {i: 0 for i in by_id}
    for r in rows:
        counts[r.doc_id] += 1
    assert all(int(rate) <= counts[i] <= int(rate) + 1 and counts[i] >= 1 for i, rate in by_id.items())


def test_edge_rows(spark):
    df = edge_rows(spark)
    labels = spark.createDataFrame([(3, "a"), (5, "b"), (5, None), (None, "a")], "doc_id bigint, domain string")
    rates = mixing.mix(df, labels)
    rows = {r.doc_id: r for r in rates.collect()}
    assert len(rows) == 11 and rows[1].n_tokens == 0 and rows[5].n_tokens == 16 and rows[None].n_tokens == 2
    assert set(mixing.repeat_by_rate(df, rates).columns) == set(df.columns)
    assert mixing.mix(narrow(spark, []), labels).collect() == []
    # Without any labelled document nothing is known to be mixed.
    alone = mixing.mix(df, labels.where("doc_id > 99"))
    assert [(r.rate, r.domains) for r in alone.collect()] == [(1.0, {})] * 11
    assert mixing.repeat_by_rate(df, alone).count() == df.count()


@pytest.mark.parametrize("keep_all", [False, True])
def test_rates_reach_the_optimum(spark, keep_all):
    """No step along the projected gradient is left, and the loss is that of 200,000 plain steps
    in numpy."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet([1, 1, 1], 40)
    n = rng.integers(5, 50, 40).astype(float)
    present = n @ p
    targets = np.array([0.0, 0.2, 0.8]) * present.sum() * (2 if keep_all else 1)
    rows = [(i, int(n[i]), *map(float, p[i])) for i in range(40)]
    soft = spark.createDataFrame(rows, "key int, n_tokens bigint, p0 double, p1 double, p2 double")
    settings, least = Settings(pull=1e-3, keep_all=keep_all), float(keep_all)
    rated, reached = mixing.solved_rates(soft, list(targets), list(present), settings)
    found = np.array([r.rate for r in rated.orderBy("key").collect()])

    def step(r):
        change = p @ ((n * r @ p - targets) / present) + settings.pull * (r - 1)
        return np.maximum(least, r - change / (1 + settings.pull))

    def loss(x):
        return (((n * x @ p - targets) ** 2) / present).sum() / 2 + settings.pull * (n * (x - 1) ** 2).sum() / 2

    best = np.ones(40)
    for _ in range(200_000):
        best = step(best)
    assert np.abs(step(found) - found).max() < 1e-5 and np.allclose(reached, n * found @ p)
    assert loss(found) == pytest.approx(loss(best), rel=1e-6) and np.allclose(found, best, atol=1e-4)


def test_mixing_is_solved_or_refused(spark):
    """Overlapping domains through ``mix``: the rates are a fixed point of the projected gradient."""
    docs, labels = corpus(spark)
    weights, settings = {"a": 0.02, "b": 0.98}, Settings(temper=40.0)
    rows = mixing.mix(docs, labels, weights, settings=settings).collect()
    p, n, r = (np.array(x) for x in zip(*[((x.domains["a"], x.domains["b"]), x.n_tokens, x.rate) for x in rows]))
    targets = np.array([0.02, 0.98]) * n.sum()
    change = p @ ((n * r @ p - targets) / (n @ p)) + settings.pull * (r - 1)
    assert np.abs(np.maximum(0, r - change) - r).max() < 1e-5
    with pytest.raises(RuntimeError):
        mixing.mix(docs, labels, weights, settings=Settings(temper=40.0, passes=1))
