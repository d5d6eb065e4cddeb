import public_tokenizers
import regex
from rows_at_the_edge import narrow

from stayflow.llm import bpe, minhash, remembered, rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def blob():
    with open(RANKS, "rb") as file:
        return file.read()


def test_a_worker_keeps_the_memory_of_one_kind_of_work():
    encoder = bpe.encoder(blob(), public_tokenizers.PATTERN)
    tokens = bpe.tokens_by_id(blob())
    assert bpe.encoder(blob(), public_tokenizers.PATTERN) is encoder and bpe.tokens_by_id(blob()) is tokens
    hashes = minhash.word_hashes()
    assert minhash.word_hashes() is hashes and set(remembered.KEPT.made) == {"hashes"}
    assert bpe.encoder(blob(), public_tokenizers.PATTERN) is not encoder
    assert bpe.encoder(b"YQ== 0", public_tokenizers.PATTERN).ranks == {b"a": 0}
    assert remembered.KEPT.begin(minhash.word_hashes) is minhash.word_hashes()
    remembered.KEPT.begin(lambda: len)
    assert not remembered.KEPT.made


def test_a_task_that_keeps_nothing_drops_what_its_worker_keeps(spark):
    """As the classifier's tasks, which follow those of the encoder when the pipeline runs again."""
    df = narrow(spark, [(i, f"some words {i}") for i in range(20)])

    def made(what):
        def make():
            if what:
                minhash.word_hashes()["seen"] = 1
            return lambda value: (len(remembered.KEPT.made),)

        return make

    # One partition each time, so the same worker takes the tasks in turn.
    for what, kept in ((True, 1), (False, 0)):
        out = rows.add_columns(df.coalesce(1), "text", "kept bigint", made(what)).collect()
        assert {r.kept for r in out} == {kept}


def test_a_plain_word_is_one_match():
    known = remembered.one_match(public_tokenizers.PATTERN)
    split = regex.compile(public_tokenizers.PATTERN).findall
    for word in (" word", "word", "A", " Zz"):
        assert known(word) and split(word) == [word]
    for other in ("", " ", "  word", "word ", "it's", "é", "a1", "a b", "\nword", "word\n", "'s", "'word"):
        assert not known(other)
    for pattern in ("", r"\p{L}{1,3}| ?\p{L}+", r"(?i:'s|'t)| ?\p{L}+", r" ?\p{L}+?"):
        assert not remembered.one_match(pattern)("word")
