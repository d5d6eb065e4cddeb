import os
import resource
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import new_dir
from rows_at_the_edge import edge_rows, narrow
from tokenizers import Tokenizer

from stayflow.llm import queries, token_store
from stayflow.llm.token_store import Codes, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 8, 9, 511, 512, 513, 3_000])
@pytest.mark.parametrize("top", [200, 257, 50_000, 2**32])
def test_codes_give_any_stretch(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    codes = Codes(pack(ids))
    assert len(codes) == n and (codes.slice(0, n) == ids).all()
    for a, b in np.sort(rng.integers(0, n + 1, (20, 2)), axis=1):
        assert (codes.slice(a, b) == ids[a:b]).all()
    assert all(codes[i] == ids[i] for i in range(0, n, 61))


@pytest.mark.parametrize("pattern", [None, public_tokenizers.PATTERN])
def test_store_equals_the_library(spark, pattern):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    df = edge_rows(spark)
    path = new_dir("tokens") + "/t"
    token_store.write_tokens(df.repartition(3), path, PATH, end_id=0, pattern=pattern)
    rows = sorted(token_store.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in rows] == [False] * 2 + [True] * (len(rows) - 2)
    assert [r.doc_id for r in rows[2:]] == sorted(r.doc_id for r in rows[2:])
    start, left = 0, [(r.doc_id, r.text or "") for r in df.collect()]
    for row in rows:
        ids = np.frombuffer(row.token_ids, "<u4").tolist()
        assert row.start == start and row.n_tokens == len(ids) and ids[-1] == 0
        start += len(ids)
        left.remove(next(x for x in left if x[0] == row.doc_id and tokenizer.encode(x[1], add_special_tokens=False).ids == ids[:-1]))
    assert not left


def test_special_token_text_is_ordinary(spark):
    path = new_dir("tokens") + "/t"
    token_store.write_tokens(narrow(spark, [(1, "a<|endoftext|>b")]), path, PATH, pattern=public_tokenizers.PATTERN)
    (row,) = token_store.read_tokens(spark, path).collect()
    assert 50_256 not in np.frombuffer(row.token_ids, "<u4").tolist()


def test_empty_table(spark):
    path = new_dir("tokens") + "/t"
    token_store.write_tokens(narrow(spark, []), path, PATH)
    assert token_store.read_tokens(spark, path).collect() == []


def test_query_encodes_as_the_plain_library(spark):
    """The library as it is loaded, no flag set: the added token's text is one id."""
    texts = ["a<|endoftext|>b", "<|endoftext|>", "  <|endoftext|><|endoftext|> x\n\n y", "<|endoftext", "plain  text\n", "", None]
    folder, tokenizer = new_dir("documents"), Tokenizer.from_file(PATH)
    narrow(spark, list(enumerate(texts))).write.parquet(f"{folder}/documents.parquet")
    rows = queries.op10_token_store(spark, folder).orderBy("doc_id").collect()
    start = 0
    for row, text in zip(rows, texts, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [64, 50_256, 65]


def test_a_match_is_remembered_once():
    """Not again as a stretch of its own, so that fewer strings fill a worker's memory."""
    memory = token_store.TokenizerMemory(PATH, public_tokenizers.PATTERN)
    memory.encode([" zorglub zorglub zorglub, zorglub. zorglub\n\n zorglub"])
    assert sorted(k for k in memory if "zorglub" in k) == [" zorglub"]
    assert all(k not in memory.joined for k in memory)


def test_ids_are_read_a_stretch_of_documents_at_a_time(spark, monkeypatch):
    """Not with a call a document, which takes longer than the ids of short documents do."""
    folder = new_dir("slices")

    class Noted(Codes):
        def slice(self, start, end, level=0):
            if not level:
                open(f"{folder}/{uuid.uuid4()}", "w").close()
            return super().slice(start, end, level)

    rows = [(i, None if i % 9 == 0 else f"text {i} é" * (i % 40)) for i in range(300)]
    path = new_dir("tokens") + "/t"
    token_store.write_tokens(narrow(spark, rows).coalesce(1), path, PATH, end_id=0, pattern=public_tokenizers.PATTERN)
    monkeypatch.setattr(token_store, "Codes", Noted)
    stored, tokenizer, start = token_store.read_tokens(spark, path).orderBy("doc_id").collect(), Tokenizer.from_file(PATH), 0
    for row, (i, text) in zip(stored, rows, strict=True):
        ids = np.frombuffer(row.token_ids, "<u4").tolist()
        assert (row.doc_id, row.start, ids) == (i, start, [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0])
        start += len(ids)
    assert 0 < len(os.listdir(folder)) < 60


def test_remembered_stretches_are_found_without_python(monkeypatch):
    """Whether they are one match or several."""
    memory = token_store.TokenizerMemory(PATH, public_tokenizers.PATTERN)
    texts = [" zorglub, zorglub (zorglub)\n\n zorglub.", "zorglub"]
    once = [ids.tolist() for ids in memory.encode(texts)]
    assert once == [memory.whole(text).tolist() for text in texts] and " zorglub," in memory.joined
    monkeypatch.setattr(memory.joined, "worked_out", None)
    assert [ids.tolist() for ids in memory.encode(texts)] == once


@pytest.mark.parametrize("piece", [" word", "word", "a b", "  ", "\n", "\t x", "\x7f", "\x1b", "!\"#", " é", " ", "~", "­"])
def test_a_match_is_written_in_the_characters_of_the_vocabulary(piece):
    memory = token_store.TokenizerMemory(PATH, public_tokenizers.PATTERN)
    written = "".join(memory.characters[byte] for byte in piece.encode())
    seen = []
    memory.model = type("Model", (), {"tokenize": staticmethod(lambda text: seen.append(text) or [])})
    memory.work_out(piece)
    assert seen == [written]


def test_reading_leaves_no_memory_behind(spark):
    """Views of an array handed to Arrow stayed in the worker, with the arrays."""
    path = new_dir("tokens") + "/t"
    docs = spark.range(4_000).selectExpr("id doc_id", "repeat('words of a text, ', 200) text")
    token_store.write_tokens(docs.coalesce(1), path, PATH, end_id=0, pattern=public_tokenizers.PATTERN)

    def held(batches):
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"kb": [before, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss]})

    # A worker that has read 4,000 times 800 ids, 13 MB, several times takes no more memory than at first.
    sizes = []
    for _ in range(6):
        token_store.read_tokens(spark, path).coalesce(1).selectExpr("sum(n_tokens)").collect()
        sizes.append(max(r.kb for r in spark.range(1).coalesce(1).mapInArrow(held, "kb bigint").collect()))
    assert sizes[-1] - sizes[1] < 25_000
