import random
import re
from collections import Counter

from pyspark.sql import functions as F
from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import quality_rules
from stayflow.llm.quality_rules import Condition, Settings

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated))


def test_counts_equal_brute_force(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a ", "b ", "cc ", "\n", "d#|\t", "é ", "a b cc "]) for _ in range(n)) for n in range(120)]
    many = " ".join(f"w{i % 300}" for i in range(900))  # more repeated windows than are looked up
    texts += [many, many + " end end end", "\x0b\x0c\r a\r\nb\r\nb", "x x x x"]
    rows = quality_rules.with_statistics(narrow(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_filter_on_statistics_keeps_their_steps_apart(spark):
    stats = quality_rules.with_statistics(narrow(spark, [(1, "a b c a b c")])).where("n_repeat_words > 2")
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4 and [r.n_repeat_words for r in stats.collect()] == [6]


def test_learns_the_rule_that_made_the_labels(spark):
    rng, rows, labels = random.Random(4), [], []
    for i in range(500):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 120))]
        if i % 4 == 0:
            words = [w + "##" for w in words]
        elif i % 9 == 0:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not (i % 4 == 0 or i % 9 == 0))))
    docs = narrow(spark, rows)
    rules = quality_rules.learn(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert 1 <= len(rules) <= Settings().max_rules
    verdicts = quality_rules.with_statistics(docs).select("doc_id", quality_rules.verdict(rules).alias("kept"))
    wrong = [r for r in verdicts.collect() if int(r.kept) != dict(labels)[r.doc_id]]
    assert wrong == []


def test_a_threshold_among_many_values_is_found(spark):
    """Labels by a number of words that is no quantile of the texts: one exact condition."""
    rng = random.Random(7)
    sizes = [rng.randrange(50, 4_000) for _ in range(600)]
    docs = narrow(spark, [(i, " ".join(f"w{k % 311}" for k in range(n))) for i, n in enumerate(sizes)])
    labels = spark.createDataFrame([(i, int(n <= 1_234)) for i, n in enumerate(sizes)], "doc_id bigint, quality int")
    rules = quality_rules.learn(docs, labels)
    stats = quality_rules.with_statistics(docs).select("doc_id", quality_rules.verdict(rules).alias("kept"))
    wrong = [r for r in stats.collect() if r.kept != (sizes[r.doc_id] <= 1_234)]
    # A third of the rows prune and do not grow: the next one of these above the bound may be on either side.
    assert len(rules) == 1 and len(wrong) <= 1


def test_rules_are_tried_in_order(spark):
    rules = [(Condition("n_words", True, 3.0),), (Condition("n_words", False, 1.0), Condition("chars_per_word", True, 2.0))]
    docs = narrow(spark, [(1, "a b c d"), (2, "abc"), (3, "ab"), (4, "a b")])
    kept = quality_rules.with_statistics(docs).where(quality_rules.verdict(rules)).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [3, 4]


def test_no_labels_and_edge_rows(spark):
    df = edge_rows(spark)
    labels = spark.createDataFrame([(0, None), (None, 1)], "doc_id bigint, quality int")
    assert quality_rules.learn(df, labels) == []
    rows = quality_rules.with_statistics(df).collect()
    assert len(rows) == df.count()
    texts = [(r.doc_id, r.text) for r in df.collect()]
    assert Counter((r.doc_id, *(r[c] for c in COUNTS)) for r in rows) == Counter((i, *brute(t)) for i, t in texts)
    assert quality_rules.with_statistics(narrow(spark, [])).where(F.col("n_words") > 1).collect() == []
