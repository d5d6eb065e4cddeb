import random

import pytest

from stayflow.llm import hamming


def brute(rows, queries, k):
    known = {}
    for i, c in rows:
        if i is not None and c is not None:
            known[i] = min(c, known.get(i, c))
    out = []
    for q, c in {(i, known.get(i)) for i, c in queries if i in known}:
        near = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), i) for i, d in known.items() if i != q)[:k]
        out += [(q, i, d, n + 1) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("segments", [None, 4])
def test_equals_brute_force(spark, segments):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(6)]
    rows = []
    for i in range(400):
        code = rng.choice(centres)
        for _ in range(rng.randrange(9)):
            code ^= 1 << rng.randrange(64)
        rows.append((i, code - (1 << 64) if code >> 63 else code))
    rows += [(1_000 + i, rows[0][1]) for i in range(60)]  # one code many rows share
    rows += [(3, 5), (3, 5), (None, 1), (7, None)]
    df = spark.createDataFrame(rows, "id bigint, code bigint")
    queries = df.where("id % 20 = 0")
    found = hamming.nearest(df, queries, 5, segments=segments).collect()
    assert sorted(map(tuple, found)) == brute(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], 5)


def test_fewer_rows_than_asked_and_none(spark):
    df = spark.createDataFrame([(1, 0), (2, -1), (3, 1)], "id bigint, code bigint")
    found = hamming.nearest(df, df.where("id = 1"), 10, segments=8).collect()
    assert sorted(map(tuple, found)) == [(1, 2, 64, 2), (1, 3, 1, 1)]
    assert hamming.nearest(df.where("id > 9"), df, 3).collect() == []


def test_sign_code(spark):
    vectors = [([1.0, -1.0, 2.0],), ([None, 1.0],), (None,), ([],), ([-1.0] * 63 + [1.0],), ([1.0] + [0.0] * 63 + [1.0],)]
    df = spark.createDataFrame(vectors, "v array<float>")
    assert [r.c for r in df.select(hamming.sign_code("v").alias("c")).collect()] == [5, 2, None, 0, -(2**63), 0]
