"""Token ids on disk as directly addressable codes, read back without decoding whole blocks."""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stayflow.llm.remembered import KEPT, Stretches

# Ids of one block, about; a document's ids are never divided between blocks.
BLOCK_IDS = 1 << 18
# Marks whose number a rank directory entry sums up.
STEP = 512
ROWS_AT_ONCE = 64


def pack(ids: np.ndarray) -> bytes:
    """Directly addressable codes of ids below 2**32.

    Level 0 has the lowest byte of every id and a mark where the id goes on; level 1 the next
    byte of those that go on, and so forth. Each level: entries (8 bytes), bytes, marks
    (one bit each), and the marks before every ``STEP`` entries (4 bytes each).
    """
    levels, rest = [], np.asarray(ids, np.uint32)
    while True:
        goes_on = rest > 0xFF
        counts = np.add.reduceat(goes_on, np.arange(0, len(rest), STEP)) if len(rest) else []
        directory = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(rest) else np.zeros(0)
        levels.append(
            struct.pack("<Q", len(rest))
            + (rest & 0xFF).astype(np.uint8).tobytes()
            + np.packbits(goes_on, bitorder="little").tobytes()
            + directory.astype("<u4").tobytes()
        )
        if not goes_on.any():
            return struct.pack("<B", len(levels)) + b"".join(levels)
        rest = rest[goes_on] >> 8


class Codes:
    """Reads single ids or stretches of them from ``pack``'s bytes, which stay as they are."""

    def __init__(self, packed: bytes) -> None:
        self.levels, at = [], 1
        for _ in range(packed[0]):
            (n,) = struct.unpack_from("<Q", packed, at)
            low = np.frombuffer(packed, np.uint8, n, at + 8)
            marks = np.frombuffer(packed, np.uint8, -(-n // 8), at + 8 + n)
            directory = np.frombuffer(packed, "<u4", -(-n // STEP), at + 8 + n + len(marks))
            self.levels.append((low, marks, directory))
            at += 8 + n + len(marks) + 4 * len(directory)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _marks(self, level: int, start: int, end: int) -> np.ndarray:
        marks = self.levels[level][1][start // 8 : -(-end // 8)]
        return np.unpackbits(marks, bitorder="little")[start % 8 : start % 8 + end - start]

    def _rank(self, level: int, place: int) -> int:
        """Marks before a place: a directory entry and the marks of less than one step."""
        step = place // STEP
        if step == len(self.levels[level][2]):
            step -= 1
        if step < 0:
            return 0
        return int(self.levels[level][2][step]) + int(self._marks(level, step * STEP, place).sum())

    def slice(self, start: int, end: int, level: int = 0) -> np.ndarray:
        """The ids at ``start`` to ``end``, touching only their own bytes."""
        ids = self.levels[level][0][start:end].astype("<u4")
        on = self._marks(level, start, end).view(bool)
        if on.any():
            first = self._rank(level, start)
            ids[on] |= self.slice(first, first + int(on.sum()), level + 1) << 8
        return ids

    def __getitem__(self, place: int) -> int:
        return int(self.slice(place, place + 1)[0])


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the others in order for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (byte for byte in range(256) if byte not in own)
    return {byte: chr(byte) for byte in own} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class TokenizerMemory(Stretches):
    """A tokenizer that remembers the ids of frequent stretches of text (white space, then other
    characters) and of the matches of the split pattern in them, which its model encodes
    one by one. Only for byte-level tokenizers that split by ``pattern``. Texts with an added
    token that counts as one go through the tokenizer whole."""

    REMEMBERED, REMEMBERED_JOINED = 850_000, 350_000

    def __init__(self, path: str, pattern: str | None, special: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(pattern)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        self.has_added = re.compile("|".join(map(re.escape, added))).search if added else lambda text: None
        self.model = self.tokenizer.model
        self.characters = byte_characters()

    def work_out(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            written = piece.replace(" ", self.characters[32])
        else:
            written = piece.encode().decode("latin-1").translate(self.characters)
        tokens = self.model.tokenize(written)
        return tokens[0].id.to_bytes(4, "little") if len(tokens) == 1 else array("I", [token.id for token in tokens]).tobytes()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.split:
            return [self.whole(text) if self.has_added(text) else np.frombuffer(self.split_up(text), np.uint32) for text in texts]
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(one.ids, np.uint32) for one in encoded]


def memory(path: str, pattern: str | None, special: bool) -> TokenizerMemory:
    given = path, pattern, special
    return KEPT.get("token_store", "tokenizer", given, lambda: TokenizerMemory(*given))


def write_tokens(
    df: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    pattern: str | None = None,
    special: bool = False,
) -> None:
    """Encode ``text`` and store the ids under ``path`` in ascending ``key`` order.

    ``tokenizer`` is a tokenizer file that every executor has; special tokens in a text are
    ordinary text unless ``special``, which gives them their ids as the library does by default.
    A byte-level tokenizer is faster with the ``pattern`` it splits texts by, and gives the same
    ids. ``end_id`` is appended to each document. Null texts count as empty, null
    keys come first, rows of one key follow a hash of their texts. One shuffle: rows are
    range-partitioned by key, and each task writes its blocks in order. A block row holds
    part, block, ids before it in the part, its number of ids, its keys, their sizes and codes.
    """
    kind = df.schema[key].dataType
    ties = F.xxhash64(F.col(text))
    placed = df.select(F.col(key).alias("key"), F.col(text).alias("text"), ties.alias("tie"))
    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    end = np.array([] if end_id is None else [end_id], "<u4")
    columns = {
        "part": pa.int32(),
        "block": pa.int32(),
        "before": pa.int64(),
        "n_ids": pa.int64(),
        "keys": pa.list_(to_arrow_type(kind)),
        "sizes": pa.list_(pa.int64()),
        "codes": pa.binary(),
    }
    schema = pa.schema(list(columns.items()))
    ddl = f"part int, block int, before bigint, n_ids bigint, keys array<{kind.simpleString()}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = memory(tokenizer, pattern, special).encode
        part, block, before = TaskContext.get().partitionId(), 0, 0
        keys, ids, held = [], [], 0

        def stored() -> pa.RecordBatch:
            codes = pack(np.concatenate(ids) if ids else np.zeros(0, "<u4"))
            row = [part, block, before, held, keys, [len(x) for x in ids], codes]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, columns.values())], schema=schema
            )

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(start, ROWS_AT_ONCE)
                texts = [value or "" for value in rows.column(1).to_pylist()]
                for one, own in zip(rows.column(0).to_pylist(), encode(texts)):
                    keys.append(one)
                    ids.append(np.concatenate([own, end]))
                    held += len(ids[-1])
                    if held >= BLOCK_IDS:
                        yield stored()
                        block, before = block + 1, before + held
                        keys, ids, held = [], [], 0
        if keys:
            yield stored()

    placed.mapInArrow(run, f"{ddl}, sizes array<bigint>, codes binary").write.parquet(path)


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, token_ids) of every document stored under ``path``.

    ``start`` counts the ids of all documents before it; ``token_ids`` are packed as
    little-endian unsigned 32-bit integers. Only one total per part (at most one per shuffle
    partition of the writer) is summed up and broadcast.
    """
    blocks = spark.read.parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    offsets = totals.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("offset"))
    placed = blocks.join(F.broadcast(offsets), "part").select(
        (F.col("offset") + F.col("before")).alias("start"), "keys", "sizes", "codes"
    )
    kind = blocks.schema["keys"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        KEPT.forget()
        for batch in batches:
            for i in range(batch.num_rows):
                start, keys, sizes, packed = (batch.column(c)[i].as_py() for c in range(4))
                codes, ends = Codes(packed), np.cumsum(sizes)
                for lo in range(0, len(keys), ROWS_AT_ONCE):
                    hi = min(lo + ROWS_AT_ONCE, len(keys))
                    spans = [(int(e) - n, int(e)) for n, e in zip(sizes[lo:hi], ends[lo:hi])]
                    # One stretch for all of these documents; it is cut where they end.
                    first = spans[0][0]
                    packed_ids = codes.slice(first, spans[-1][1]).tobytes()  # of views, Arrow never lets go
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[lo:hi], to_arrow_type(kind)),
                            pa.array([start + a for a, _ in spans], pa.int64()),
                            pa.array(sizes[lo:hi], pa.int64()),
                            pa.array([packed_ids[4 * (a - first) : 4 * (b - first)] for a, b in spans], pa.binary()),
                        ],
                        [key, "start", "n_tokens", "token_ids"],
                    )

    ddl = f"`{key}` {kind.simpleString()}, start bigint, n_tokens bigint, token_ids binary"
    return placed.mapInArrow(run, ddl)
