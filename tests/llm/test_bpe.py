import base64
import random

import public_tokenizers
import pytest
import tiktoken
from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_queue_gives_ranks_in_order_and_leftmost_first():
    queue, rng = bpe.RankQueue(60_000), random.Random(5)
    entries = [(rng.choice([0, 1, 63, 64, 4095, 4096, 59_999, rng.randrange(60_000)]), rng.randrange(99)) for _ in range(3_000)]
    for entry in entries:
        queue.push(*entry)
    assert [queue.pop() for _ in entries] == sorted(entries)
    assert not queue.top and not queue.buckets


def test_ids_equal_the_library(reference):
    with open(RANKS, "rb") as file:
        encoder = bpe.encoder(file.read(), public_tokenizers.PATTERN)
    rng = random.Random(1)
    alphabet = "aaabet  \n\t\r'st!?09é日  \x1ć😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(2_000)]
    texts += ["a" * 5_000, "ab" * 2_000, "é" * 2_000, "".join(rng.choice("etaoin") for _ in range(20_000))]
    for text in texts:
        assert bpe.unpack(encoder.encode(text)) == reference.encode_ordinary(text)


def test_round_trip_of_edge_rows(spark, reference):
    df = edge_rows(spark)
    rows = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert len(rows) == df.count()
    for row in rows:
        text = row.text or ""
        assert bpe.unpack(row.token_ids) == reference.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode() and row.key == "own"


def test_empty_table(spark):
    df = narrow(spark, [])
    assert bpe.encode(df, RANKS, public_tokenizers.PATTERN).collect() == []


def test_a_match_is_remembered_once():
    """Not again as a stretch of its own, so that fewer strings fill a worker's memory."""
    with open(RANKS, "rb") as file:
        encoder = bpe.Encoder(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)
    encoder.encode(" zorglub zorglub zorglub, zorglub. zorglub\n\n zorglub")
    assert sorted(k for k in encoder if "zorglub" in k) == [" zorglub"]
    assert all(k not in encoder.joined for k in encoder)


def test_short_and_long_matches_are_merged_alike(monkeypatch):
    with open(RANKS, "rb") as file:
        encoder = bpe.Encoder(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)
    rng = random.Random(2)
    pieces = ["".join(rng.choice("etaoin thé😀") for _ in range(rng.randrange(1, 60))).encode() for _ in range(500)]
    short = [encoder.merge(piece) for piece in pieces]
    assert not any(encoder.words)
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [encoder.merge(piece) for piece in pieces] == short


def test_ranks_in_any_order():
    """A merge may make a pair of a lower rank than its own; the lowest one still goes first."""
    rng = random.Random(6)
    for _ in range(200):
        tokens = {bytes([c]) for c in b"abc"} | {bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 5))) for _ in range(25)}
        order = list(tokens)
        rng.shuffle(order)
        ranks = {token: i for i, token in enumerate(order)}
        encoder = bpe.Encoder(ranks, r"\S+")
        for _ in range(10):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 12)))
            parts = [piece] if piece in ranks else [piece[i : i + 1] for i in range(len(piece))]
            while known := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
                _, i = min(known)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert encoder.merge(piece) == [ranks[part] for part in parts]
