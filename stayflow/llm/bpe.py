"""Byte-level BPE: merging by a bitmap queue of ranks, and decoding."""

from __future__ import annotations

import base64
from array import array
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from stayflow.llm import remembered
from stayflow.llm.remembered import Stretches
from stayflow.llm.rows import add_columns

# Bytes of a match up to which positions of a rank fit a few machine words.
SHORT = 256


def read_ranks(blob: bytes) -> dict[bytes, int]:
    """A rank file: one line per token, its bytes in base64 and its rank."""
    pairs = (line.split() for line in blob.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class RankQueue:
    """Positions in buckets by rank; three levels of 64-bit words mark the filled buckets.

    Finding the smallest rank is one find-first-set per level, however many entries there are.
    """

    def __init__(self, ranks: int) -> None:
        self.low = [0] * ((ranks >> 6) + 1)
        self.middle = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word = rank >> 6
        if not self.low[word]:
            group = word >> 6
            if not self.middle[group]:
                self.top |= 1 << group
            self.middle[group] |= 1 << (word & 63)
        self.low[word] |= 1 << (rank & 63)

    def pop(self) -> tuple[int, int]:
        """The smallest rank and its leftmost position."""
        group = (self.top & -self.top).bit_length() - 1
        marks = self.middle[group]
        word = (group << 6) + (marks & -marks).bit_length() - 1
        marks = self.low[word]
        rank = (word << 6) + (marks & -marks).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.low[word] &= marks - 1
            if not self.low[word]:
                self.middle[group] &= self.middle[group] - 1
                if not self.middle[group]:
                    self.top &= self.top - 1
        return rank, position


class Encoder(Stretches):
    """Text to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__(pattern)
        self.ranks = ranks
        self.longest_token = max(map(len, ranks), default=0)
        most = max(ranks.values(), default=0)
        self.queue = RankQueue(most + 1)
        # For short matches: ranks of all single bytes and pairs of bytes, and words of 256 bits in
        # place of the queue's two lower levels, all zero between matches.
        self.singles = [ranks.get(bytes([byte])) for byte in range(256)]
        self.pairs: list[int | None] = [None] * (1 << 16)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank
        self.words = [0] * ((most >> 8) + 1)
        self.bits = [1 << i for i in range(max(SHORT, len(self.words)))]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.split_up(text)

    def work_out(self, piece: str) -> bytes:
        return array("I", self.merge(piece.encode())).tobytes()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern: the pair of least rank is merged first, the leftmost
        of equal ones. Entries whose pair has changed meanwhile are stale and skipped."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= SHORT:
            return self.merge_short(piece)
        n, rank_of, queue = len(piece), self.ranks.get, self.queue
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        pair: list[int | None] = [rank_of(piece[i : i + 2]) for i in range(n - 1)] + [None]
        for i, rank in enumerate(pair):
            if rank is not None:
                queue.push(rank, i)
        while queue.top:
            rank, i = queue.pop()
            if pair[i] != rank:
                continue
            j = after[i]
            end = after[i] = after[j]
            pair[j] = None
            before[end] = i
            pair[i] = None
            if end < n:
                stop = after[end]
                if stop - i <= self.longest_token and (made := rank_of(piece[i:stop])) is not None:
                    pair[i] = made
                    queue.push(made, i)
            start = before[i]
            if start >= 0:
                pair[start] = None
                if end - start <= self.longest_token and (made := rank_of(piece[start:end])) is not None:
                    pair[start] = made
                    queue.push(made, start)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def merge_short(self, piece: bytes) -> list[int]:
        """``merge`` with the queue in two levels: a bit for each filled word of 256 ranks, a bit for
        each rank in it, and for a rank the bits of its positions."""
        rank_of, words, top, places = self.ranks.get, self.words, 0, {}
        pairs, singles, bits, n = self.pairs, self.singles, self.bits, len(piece)
        pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        for i, rank in enumerate(pair):
            if rank is None:
                continue
            if rank in places:
                places[rank] |= bits[i]
            else:
                places[rank] = bits[i]
                words[rank >> 8] |= bits[rank & 255]
                top |= bits[rank >> 8]
        pair.append(None)
        token = [singles[byte] for byte in piece]
        after, before = [*range(1, n + 1)], [*range(-1, n)]
        while top:
            word = (top & -top).bit_length() - 1
            marks = words[word]
            rank = word << 8 | (marks & -marks).bit_length() - 1
            filled = places.pop(rank)
            i = (filled & -filled).bit_length() - 1
            filled &= filled - 1
            if filled:
                places[rank] = filled
            else:
                marks &= marks - 1
                words[word] = marks
                if not marks:
                    top &= top - 1
            if pair[i] != rank:
                continue
            token[i] = rank
            j = after[i]
            end = after[i] = after[j]
            pair[j] = pair[i] = None
            before[end] = i
            if end < n and (made := rank_of(piece[i : after[end]])) is not None:
                pair[i] = made
                if made in places:
                    places[made] |= bits[i]
                else:
                    places[made] = bits[i]
                    words[made >> 8] |= bits[made & 255]
                    top |= bits[made >> 8]
            if i:
                start = before[i]
                pair[start] = made = rank_of(piece[start:end])
                if made is not None:
                    if made in places:
                        places[made] |= bits[start]
                    else:
                        places[made] = bits[start]
                        words[made >> 8] |= bits[made & 255]
                        top |= bits[made >> 8]
        ids, i = [], 0
        while i < n:
            ids.append(token[i])
            i = after[i]
        return ids


# Kept between the tasks of a Python worker, with what it remembers.
def encoder(blob: bytes, pattern: str) -> Encoder:
    return remembered.KEPT.get("bpe", "encoder", (blob, pattern), lambda: Encoder(read_ranks(blob), pattern))


def tokens_by_id(blob: bytes) -> list[bytes]:
    def make() -> list[bytes]:
        ranks = read_ranks(blob)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        return tokens

    return remembered.KEPT.get("bpe", "tokens", blob, make)


def _shared(df: DataFrame, ranks_path: str):
    """The rank file, sent once to each executor; it does not grow with the data."""
    with open(ranks_path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Add ``ids``: each text's token ids, packed as little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is merged by itself; special tokens have no meaning. Null and
    empty texts have no ids. A column named ``ids`` is replaced, others are kept. No shuffle.
    """
    shared = _shared(df, ranks_path)

    def make():
        encode_text = encoder(shared.value, pattern).encode
        return lambda value: (encode_text(value) if value else b"",)

    return add_columns(df, text, f"`{ids}` binary", make)


def decode(df: DataFrame, ranks_path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes the packed ids stand for; null ids give no bytes. Bytes, as ids
    cut anywhere may end within a character."""
    shared = _shared(df, ranks_path)

    def make():
        token = tokens_by_id(shared.value).__getitem__
        return lambda value: (b"".join(map(token, np.frombuffer(value or b"", "<u4").tolist())),)

    return add_columns(df, ids, f"`{out}` binary", make)


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()
