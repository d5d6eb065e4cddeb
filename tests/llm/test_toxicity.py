import random

from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import toxicity
from stayflow.llm.toxicity import Model, Settings, regression

WORDS = [f"{a}{b}" for a in ("lor", "ip", "dol", "sit", "am", "con") for b in ("em", "sum", "or", "et", "adi", "pis")]


def corpus(spark, n=600):
    """Every fifth text is abusive; most abusive ones name a group, few of the others do."""
    rng, rows, labels = random.Random(3), [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(20, 60))]
        bad = i % 5 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["slimebag", "dunderhead"]))
        if rng.random() < (0.9 if bad else 0.02):
            words.insert(rng.randrange(len(words)), rng.choice(["muslims", "jews", "christians"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return narrow(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy_and_neutral_mentions(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 4 > 0"), settings=Settings(least_gain=8.0))
    held = {r.doc_id: r.score for r in toxicity.score(docs.where("doc_id % 4 = 0"), model).collect()}
    assert all((score >= 0.5) == (i % 5 == 0) for i, score in held.items())
    neutral = narrow(spark, [(1, "lorem ipsum muslims dolor"), (2, "sitet jews amor"), (3, "lorem slimebag")])
    scores = [r.score for r in toxicity.score(neutral, model).orderBy("doc_id").collect()]
    assert scores[0] < 0.5 and scores[1] < 0.5 and scores[2] >= 0.5
    # Without the penalty the mention itself raises the score.
    plain = toxicity.fit(docs, labels, settings=Settings(least_gain=8.0, counterfactual=0.0))
    assert toxicity.Scorer(plain).score("lorem jews") > 2 * toxicity.Scorer(model).score("lorem jews")


def test_penalty_levels_swapped_features():
    import numpy as np

    rows, labels = [[0], [1], [], []] * 20, np.array([1.0, 1.0, 0.0, 0.0] * 20)
    pairs = [([0], [2]), ([2], [0])] * 10
    _, free = regression(rows, labels, [], 3, Settings(counterfactual=0.0))
    _, level = regression(rows, labels, pairs, 3, Settings(counterfactual=10.0))
    assert abs(free[0] - free[2]) > 2 and abs(level[0] - level[2]) < 0.5


def test_regression_reaches_the_optimum():
    """The penalised loss is convex: small steps of plain gradient descent find the same weights."""
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [sorted(rng.choice(8, rng.integers(1, 5), replace=False).tolist()) for _ in range(120)]
    labels = np.array([float(0 in r or (3 in r and rng.random() < 0.8)) for r in rows])
    pairs = [(r, sorted({(x + 1) % 8 for x in r})) for r in rows[:40]]
    settings = Settings(counterfactual=2.0, ridge=1e-2)
    x, own, other = (np.zeros((len(m), 8)) for m in (rows, pairs, pairs))
    for i, r in enumerate(rows):
        x[i, r] = 1
    for i, (a, b) in enumerate(pairs):
        own[i, a], other[i, b] = 1, 1
    w, bias, change = np.zeros(8), 0.0, own - other
    for _ in range(60_000):
        error = (1 / (1 + np.exp(-(x @ w + bias))) - labels) / len(rows)
        w -= 0.2 * (x.T @ error + settings.ridge * w + 2.0 / len(pairs) * change.T @ (change @ w))
        bias -= 0.2 * error.sum()
    found_bias, found = regression(rows, labels, pairs, 8, settings)
    assert np.allclose(found, w, atol=2e-2) and abs(found_bias - bias) < 2e-2


def test_counterfactuals_without_identity_terms(spark):
    """Common words of harmless texts stand in, whatever the language."""
    rng, rows, labels = random.Random(8), [], []
    mentions = [f"gruppe{c}" for c in "abcdefgh"]
    for i in range(600):
        words = [rng.choice(WORDS) for _ in range(30)]
        if i % 5 == 0:
            words.append("dunderhead")
        if i % 3 == 0:
            words.append(rng.choice(mentions))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    docs, known = narrow(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, known, settings=Settings(identity="", least_gain=8.0))
    assert model.pairs > 50
    assert toxicity.fit(docs, known, settings=Settings(identity="", neutral_terms=0, least_gain=8.0)).pairs == 0
    own = toxicity.fit(docs, known, settings=Settings(identity=" ".join(mentions), neutral_terms=0, least_gain=8.0))
    assert own.pairs == 200


def test_pairs_without_any_feature():
    """Texts that are swapped but have no word the model uses leave it as it is."""
    import numpy as np

    bias, weights = regression([[], [0]], np.array([0.0, 1.0]), [([], [])], 1, Settings(rounds=5))
    assert weights[0] > 0 and np.isfinite(bias)


def test_no_labels_or_one_kind(spark):
    docs = narrow(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.fit(docs, none) == Model(0.0, {})
    one = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "doc_id bigint, toxic int")
    assert toxicity.Scorer(toxicity.fit(docs, one)).score("a") < 0.5


def test_edge_rows(spark):
    df = edge_rows(spark)
    rows = toxicity.score(df, Model(-1.0, {"one": 3.0}), out="score").collect()
    assert len(rows) == df.count() and all(0 < r.score < 1 for r in rows)
    assert {r.text for r in rows if r.score > 0.5} == {"one"} and rows[0].key == "own"
    assert toxicity.score(narrow(spark, []), Model(0.0, {})).collect() == []
