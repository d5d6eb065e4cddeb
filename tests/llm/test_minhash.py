import random
from math import comb

import numpy as np
import pytest
from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import minhash
from stayflow.llm.components import components
from stayflow.llm.minhash import Settings
from stayflow.llm.rows import Work


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, n):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                a_root, b_root = sorted((root(a), root(b)))
                parent[b_root] = a_root
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed):
    """Unlike texts, exact copies, near copies of copies, and a long passage that many share."""
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(40)]
    base = [f"c{i}" for i in range(60)]
    for i in range(260):
        kind = i % 5
        if kind == 0:
            words = [f"u{rng.randrange(5_000)}" for _ in range(rng.randrange(1, 90))]
        elif kind == 1:
            words = passage + [f"v{rng.randrange(900)}" for _ in range(rng.randrange(30))]
        elif kind == 2:
            words = base[:]
            for _ in range(rng.randrange(9)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(12)}"
        elif kind == 3 and rows:
            words = rng.choice(rows)[1].split()
            if len(words) > 3 and rng.random() < 0.7:
                words[rng.randrange(len(words))] = "Changed"
        else:
            words = base[: rng.randrange(1, 60)]
        rows.append((i, " ".join(words)))
    return rows


def near_copies(seed):
    """Many independent copies of one text, a little more and a little less than similar to it,
    some of them changed again, and copies that share changes no other has."""
    rng, base = random.Random(seed), [f"b{i}" for i in range(80)]
    rows = []
    for i in range(240):
        words = base[:] if i % 4 else rng.choice(rows)[1].split() if rows else base[:]
        for _ in range(rng.randrange(2, 9)):
            words[rng.randrange(len(words))] = f"r{rng.randrange(6)}" if i % 3 == 0 else f"n{rng.randrange(10**6)}"
        if i % 7 == 0:
            words = words[: rng.randrange(60, 81)]
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("words, rows", [(2, corpus(2)), (5, corpus(5)), (2, near_copies(1)), (2, near_copies(2))])
def test_equals_brute_force(spark, words, rows):
    found = minhash.near_duplicates(narrow(spark, rows), settings=Settings(words=words)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, words)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 203), (204, 205)]
    rng = random.Random(1)
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in components(df, Work(spark)).collect()}
    expected = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {i: 203 for i in (203, 204, 205)}
    assert found == expected


def test_edge_rows(spark):
    df = edge_rows(spark)
    rows = minhash.near_duplicates(df).collect()
    assert len(rows) == df.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [(r.n_shingles, r.component_id, r.kept) for r in by_id[0]] == [(0, 0, True)]
    assert [r.component_id for r in by_id[4]] == [3] and not by_id[4][0].kept
    assert all(r.component_id is None and r.kept for r in by_id[None])
    assert len({r.component_id for r in by_id[5]}) == 1
    assert minhash.near_duplicates(narrow(spark, [])).collect() == []


@pytest.mark.parametrize("words, rows", [(2, corpus(4)), (2, near_copies(3))])
def test_lists_that_are_not_compared_by_sketches(spark, words, rows):
    settings = Settings(words=words, compared=2)
    found = minhash.near_duplicates(narrow(spark, rows), settings=settings).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, words)


@pytest.mark.parametrize("coordinates, least_matches", [(64, 34), (63, 33), (64, 32), (5, 3), (130, 70)])
def test_signatures_with_enough_equal_coordinates_meet(coordinates, least_matches):
    """In a span as a whole, and in their sketches, wherever the equal coordinates are."""
    settings = Settings(coordinates=coordinates, least_matches=least_matches)
    width, rng = minhash.span_width(settings), np.random.default_rng(coordinates)
    for _ in range(300):
        x = rng.integers(-(2**31), 2**31, coordinates).astype(np.int32)
        y = x.copy()
        other = rng.permutation(coordinates)[: coordinates - least_matches]
        if _ % 2:  # as many spans as can be
            other = np.argsort(np.arange(coordinates) % width, kind="stable")[: coordinates - least_matches]
        y[other] ^= 1 << rng.integers(0, 31)
        same = [(x[i : i + width] == y[i : i + width]).all() for i in range(0, coordinates, width)]
        assert sum(same) >= minhash.equal_spans(settings, width) > 0
        assert 2 * least_matches <= coordinates or width == 2
        differ = minhash.sketch(x) ^ minhash.sketch(y)
        by_word = np.bitwise_or.reduce(differ.reshape(-1, minhash.SKETCHED), axis=1)
        assert sum(int(v & 0xFFFFFFFFFFFFFFFF).bit_count() for v in by_word.tolist()) <= coordinates - least_matches


def test_unlike_texts_are_not_compared_shingle_by_shingle(spark, monkeypatch):
    """Texts that share a third of their words with many others meet by chance; their differences are no shorter than
    they are, and there would be more of them with every further document."""
    rng, rows, asked = random.Random(8), [], []
    passages = [[f"p{k}w{i}" for i in range(60)] for k in range(4)]
    for i in range(300):
        words = rng.choice(passages) + [f"u{rng.randrange(10**6)}" for _ in range(70)]
        rows.append((i, " ".join(words)))
        if i % 10 == 0:
            rows.append((1_000 + i, " ".join(words[:-3])))
    plain = minhash.from_hub

    def noted(opened, *others):
        asked.append(opened.count())
        return plain(opened, *others)

    monkeypatch.setattr(minhash, "from_hub", noted)
    found = minhash.near_duplicates(narrow(spark, rows), settings=Settings(words=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 2)
    assert asked == [0]


def test_parities_tell_no_more_than_what_differs():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = np.unique(rng.integers(0, 2**64, 500, np.uint64))
        y = np.unique(np.append(x[rng.integers(0, 120) :], rng.integers(0, 2**64, rng.integers(0, 200), np.uint64)))
        differ = minhash.parity(x, 1024) ^ minhash.parity(y, 1024)
        assert sum((v & 0xFFFFFFFFFFFFFFFF).bit_count() for v in differ.tolist()) <= len(np.setxor1d(x, y))


def test_shared_spans_are_as_likely_as_said():
    least = minhash.shared_spans(Settings(), 2)
    fewer = sum(comb(32, k) * 0.64**k * 0.36 ** (32 - k) for k in range(least))
    assert fewer < 5e-7 and least > minhash.equal_spans(Settings(), 2)


def test_texts_of_a_common_passage_are_no_group(spark, monkeypatch):
    """They share three tenths of their shingles: some spans, but not as many as similar texts."""
    rng, rows, asked = random.Random(6), [], []
    passage = [f"p{i}" for i in range(30)]
    for i in range(300):
        words = passage + [f"u{rng.randrange(10**6)}" for _ in range(70)]
        rows.append((i, " ".join(words)))
        if i % 10 == 0:
            rows.append((1_000 + i, " ".join(words[:-3])))
    plain = minhash.from_hub

    def noted(opened, *others):
        asked.append(opened.count())
        return plain(opened, *others)

    monkeypatch.setattr(minhash, "from_hub", noted)
    found = minhash.near_duplicates(narrow(spark, rows), settings=Settings(words=2, compared=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 2)
    assert asked[0] < len(rows) / 3


def test_few_pairs_below_the_limit_go_to_full_sets(spark, monkeypatch):
    """Independent copies of one text, of 0.6 or so: their signatures have 34 equal coordinates in most pairs."""
    rng, rows, asked = random.Random(7), [], []
    base = [f"b{i}" for i in range(300)]
    for i in range(60):
        words = base[:]
        for k in rng.sample(range(300), 36):
            words[k] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    plain = minhash.full_sets

    def noted(pairs, *others):
        asked.append(pairs.count())
        return plain(pairs, *others)

    monkeypatch.setattr(minhash, "full_sets", noted)
    found = minhash.near_duplicates(narrow(spark, rows), settings=Settings(words=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 2)
    assert sum(asked) < len(rows)


def test_texts_are_shuffled_only_for_very_many_keys(spark):
    rows = corpus(9)
    df = narrow(spark, rows).selectExpr("doc_id as key", "text")
    needed = df.where("key % 7 = 0").select("key").repartition(3)
    few, many = (minhash.texts_of(df, needed, Settings(sent=n)) for n in (1_000, 10))
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    assert sorted(few.collect()) == sorted(many.collect()) == sorted(df.where("key % 7 = 0").collect())
    found = minhash.near_duplicates(narrow(spark, rows), settings=Settings(words=2, sent=0)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 2)
