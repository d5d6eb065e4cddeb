import os
import random
import sys
import uuid

import numpy as np
import pyarrow as pa
import pytest
from helpers import new_dir
from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import byte_runs
from stayflow.llm.byte_runs import Settings
from stayflow.llm.suffix_array import common_prefixes, suffix_array


def test_suffix_array_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(1_500):
        size = rng.randint(1, 4)
        s = [rng.randrange(size) for _ in range(rng.randrange(45))]
        sa = suffix_array(s, size)
        assert sa == sorted(range(len(s)), key=lambda i: s[i:])
        shared = common_prefixes(s, sa)
        for a, b in zip(sa, sa[1:]):
            n = 0
            while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert shared[b] == n


def brute(rows, length):
    """Covered bytes by looking every string up among those of smaller keys."""
    first, out = {}, {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            first.setdefault(data[k : k + length], i)
    for i, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        out[i] = (len(data), sum(gone), bytes(b for b, g in zip(data, gone) if not g))
    return out


def corpus(seed):
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(30)) for _ in range(5)]
    for i in range(120):
        text = " ".join(word() for _ in range(rng.randrange(60)))
        if i % 3 == 0:
            cut = rng.randrange(len(text) + 1)
            part = rng.choice(passages)
            text = text[:cut] + part[rng.randrange(40) :] + text[cut:]
        if i % 7 == 0 and rows:
            chars = list(rng.choice(rows)[1])
            for _ in range(rng.randrange(4)):
                if chars:
                    chars[rng.randrange(len(chars))] = "Q"
            text = "".join(chars)
        rows.append((i, text))
    return rows + [(500, "ab" * 400), (501, "ab" * 300 + "x" * 300), (502, "x" * 299)]


@pytest.mark.parametrize("records", [1, 400_000])
def test_equals_brute_force(spark, records):
    rows = corpus(records)
    settings = Settings(records=records, shard_bytes=4_000)
    found = byte_runs.remove_repeated_bytes(narrow(spark, rows).repartition(4), settings=settings).collect()
    expected = brute(rows, settings.length)
    for row in found:
        n, gone, kept = expected[row.doc_id]
        assert (row.n_bytes, row.n_bytes - len(row.kept), bytes(row.kept)) == (n, gone, kept)
        assert sum(r.end - r.start for r in row.removed) == gone
        assert all(a.end < b.start for a, b in zip(row.removed, row.removed[1:]))


def test_edge_rows(spark):
    df = edge_rows(spark)
    rows = byte_runs.remove_repeated_bytes(df).collect()
    assert len(rows) == df.count() and all(bytes(r.kept) == (r.text or "").encode() for r in rows)
    assert byte_runs.remove_repeated_bytes(narrow(spark, [])).collect() == []


def test_rows_of_one_key_are_no_source_for_each_other(spark):
    text = "0123456789" * 3 + "abcdefghijklmnopqrstuvwxyz"
    rows = [(1, text), (1, text), (1, "x" + text), (None, text), (2, text + "y")]
    found = byte_runs.remove_repeated_bytes(narrow(spark, rows)).collect()
    assert sorted(bytes(r.kept).decode() for r in found) == sorted([text, text, "x" + text, text, "y"])


@pytest.mark.parametrize("sampled", [1, 10**9])
def test_a_hot_mark_is_no_group(spark, monkeypatch, sampled):
    """One passage in all documents: the text that goes through the suffix array of a shard stays
    bounded, whether the sample (of all texts, of none) sees its mark or not."""
    rng, rows = random.Random(9), []
    own = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = own(200)
    for i in range(600):
        rows.append((i, own(rng.randrange(20, 60)) + passage + own(rng.randrange(20, 60))))
    settings, folder = Settings(shard_bytes=64_000, sampled=sampled), new_dir("sizes")

    def noted(symbols, size):
        with open(f"{folder}/{uuid.uuid4()}", "w") as out:
            out.write(str(len(symbols)))
        return suffix_array(symbols, size)

    monkeypatch.setattr(byte_runs, "suffix_array", noted)
    found = byte_runs.remove_repeated_bytes(narrow(spark, rows).repartition(4), settings=settings).collect()
    expected = brute(rows, settings.length)
    assert {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), bytes(r.kept)) for r in found} == expected
    sizes = [int(open(f"{folder}/{f}").read()) for f in os.listdir(folder)]
    assert max(sizes, default=0) < 20_000


def test_units_without_repeated_keys_pack_to_half():
    """What goes through the first shuffle, compressed as a shuffle does: 40 bytes a unit as they are."""
    rng = np.random.default_rng(4)
    units = np.zeros(20_000, byte_runs.UNIT)
    units["mark"], units["own"] = rng.integers(0, 2**63, (2, len(units)), np.uint64)
    units["doc"] = np.sort(rng.integers(-5, 4_000, len(units))) + 10**12
    units["lo"], units["n"] = rng.integers(0, 4_000, len(units)), rng.integers(1, 32, len(units))
    fields = byte_runs.packed(units, compared=True)
    assert (byte_runs.unpacked(dict(zip(units.dtype.names, fields))) == units).all()
    lz4 = pa.Codec("lz4_raw")
    assert sum(len(lz4.compress(field)) for field in fields) < 22 * len(units)
    alone = byte_runs.unpacked(dict(zip(units.dtype.names, byte_runs.packed(units, compared=False))))
    for name in ("doc", "tie", "lo", "n"):
        assert (alone[name] == units[name]).all()
    ends = np.array([(1, 2, -(2**63), -1, 0, 2**32 - 1), (3, 4, 2**63 - 1, 7, 2**32 - 1, 1)], byte_runs.UNIT)
    assert (byte_runs.unpacked(dict(zip(ends.dtype.names, byte_runs.packed(ends, compared=True)))) == ends).all()
    none = byte_runs.packed(units[:0], compared=True)
    assert len(byte_runs.unpacked(dict(zip(units.dtype.names, none)))) == 0


def test_suffix_arrays_are_a_share_of_a_shard(spark, monkeypatch):
    """Near copies leave many open units: their texts are sorted in parts, not a shard at a time."""
    rng, rows = random.Random(12), []
    base = ["".join(rng.choice("abcdefgh ") for _ in range(2_000)) for _ in range(12)]
    for i in range(240):
        chars = list(base[i % 12])
        for at in range(rng.randrange(60), len(chars), 60):
            chars[at] = rng.choice("XYZ")
        rows.append((i, "".join(chars)))
    settings, folder = Settings(shard_bytes=1_000_000), new_dir("sizes")

    def noted(symbols, size):
        with open(f"{folder}/{uuid.uuid4()}", "w") as out:
            out.write(str(len(symbols)))
        return suffix_array(symbols, size)

    monkeypatch.setattr(byte_runs, "suffix_array", noted)
    found = byte_runs.remove_repeated_bytes(narrow(spark, rows).repartition(4), settings=settings).collect()
    expected = brute(rows, settings.length)
    assert {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), bytes(r.kept)) for r in found} == expected
    sizes = [int(open(f"{folder}/{f}").read()) for f in os.listdir(folder)]
    assert len(sizes) > 16 and max(sizes) < sum(sizes) / 16


def test_suffix_arrays_take_no_step_a_byte():
    """Lines of Python that run: some for each bucket and doubling, not for each byte."""
    rng, lines = random.Random(6), 0
    s = [rng.randrange(1, 27) for _ in range(60_000)]
    s = s + [0] + s[:500] + [0]

    def trace(frame, event, arg):
        nonlocal lines
        lines += event == "line"
        return trace

    before = sys.gettrace()
    sys.settrace(trace)
    try:
        sa = suffix_array(s, 257)
        shared = common_prefixes(s, sa)
    finally:
        sys.settrace(before)
    assert sorted(sa) == list(range(len(s))) and shared.max() == 500
    assert all(s[a : a + 600] < s[b : b + 600] for a, b in zip(sa, sa[1:]))
    assert lines < len(s)
    for s in ([1] * 3_000, [1, 2] * 1_500, [2, 1, 1] * 1_000):
        assert suffix_array(s, 3) == sorted(range(3_000), key=lambda i: s[i:])


def test_starts_that_follow_on_one_another_are_one_range(spark):
    """A passage with small changes in each copy: a range a stretch, not one a start."""
    rng, rows = random.Random(14), []
    base = "".join(rng.choice("abcdefgh ") for _ in range(3_000))
    for i in range(40):
        chars = list(base)
        for at in range(rng.randrange(300), len(chars), 300):
            chars[at] = rng.choice("XYZ")
        rows.append((i, 0, "".join(chars)))
    texts = spark.createDataFrame(rows, "doc bigint, tie bigint, text string").repartition(3)
    ranges = byte_runs.repeated_ranges(texts, Settings()).collect()
    starts = {(r.doc, at) for r in ranges for at in range(r.lo, r.hi)}
    first, expected = {}, set()
    for i, _, text in rows:
        for at in range(len(text) - 49):
            if first.setdefault(text[at : at + 50], i) < i:
                expected.add((i, at))
    assert starts == expected and len(ranges) < len(expected) / 5
