"""Toxicity scores from labels, kept even when only the group that is mentioned changes."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.rows import add_columns

# Terms that name groups of people; those of a line are interchangeable. Fixed values.
IDENTITY_TERMS = """
women men girls boys
woman man girl boy
female male nonbinary transgender
gay lesbian bisexual straight heterosexual homosexual queer
christian muslim jewish hindu buddhist sikh atheist
christians muslims jews hindus buddhists sikhs atheists
black white asian hispanic latino indigenous
african european american arab chinese indian mexican
africans europeans americans arabs chinese indians mexicans
blind deaf disabled autistic
old young elderly
immigrants refugees natives foreigners
frauen männer mädchen jungen
schwule lesben
juden christen muslime
femmes hommes filles garçons
juifs chrétiens musulmans
mujeres hombres niñas niños
judíos cristianos musulmanes
"""
# Lengths of word beginnings that are features besides whole words.
STEMS = (4, 5, 6, 7)
LONGEST_WORD = 40
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """``max_training``: labelled rows the model is fitted on, the first by a hash of the id.
    ``max_features``: words and word beginnings it may use. ``least_gain``: the
    log-likelihood ratio a feature must reach. ``counterfactual``: weight of the squared
    change of the score under a swap of identity terms. ``ridge``: weight of squared weights.
    ``identity``: the caller's terms, a line per group of interchangeable ones.
    ``neutral_terms``: further terms taken from the texts of label 0, in groups of
    ``neutral_group`` that are about as frequent; ``neutral_share``: share of the labelled texts
    that such a term may be in at most, as what is in most texts mentions nobody.
    Words of more than 40 characters count by their beginnings only.
    """

    max_training: int = 20_000
    max_features: int = 4_096
    least_gain: float = 15.0
    counterfactual: float = 10.0
    ridge: float = 1e-5
    rounds: int = 600
    identity: str = IDENTITY_TERMS
    neutral_terms: int = 16
    neutral_group: int = 4
    neutral_share: float = 0.05


@dataclass(frozen=True)
class Model:
    """``pairs``: labelled texts that were held against a counterfactual of theirs."""

    bias: float
    weights: dict[str, float]
    pairs: int = 0


def word_features(word: str) -> list[str]:
    stems = [f"{word[:n]}*" for n in STEMS if len(word) > n]
    return stems + [word] if len(word) <= LONGEST_WORD else stems


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(words: Iterable[str]) -> set[str]:
    return {f for word in words for f in word_features(word)}


def next_terms(identity: str) -> dict[str, str]:
    """Each identity term's replacement: the next of its line, the first after the last."""
    lines = [line.split() for line in identity.splitlines() if line.strip()]
    return {a: b for line in lines for a, b in zip(line, line[1:] + line[:1])}


def labelled_sample(labels: DataFrame, key: str, label: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled keys, in the order of a hash; a key with several labels is
    positive if one of them is. Null keys and labels are left out."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    order = F.xxhash64(key)
    parts = 1 << 30
    share = min(1.0, 1.2 * bound / max(known.count(), 1))
    picked = known.where(F.pmod(order, F.lit(parts)) < F.lit(int(share * parts)))
    single = picked.groupBy(key).agg(F.max(F.col(label)).alias("_label"))
    return single.orderBy(F.xxhash64(key), key).limit(bound)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> Model:
    """Logistic regression on the words, and beginnings of words, that tell labels apart.

    Features are counted and chosen by Spark over all sampled texts in full. Every labelled
    text with identity terms also gets a counterfactual, in which each is replaced by the next
    of its line; the squared difference of the two scores (before the logistic curve) is
    penalised, so weight cannot rest on who is mentioned. Besides the terms given, words that
    texts of label 0 commonly mention, and that are no more usual among the others, stand for
    neutral mentions; so there are counterfactuals in any language. Without labelled rows of
    both kinds the model is the share of positives. Rows of a repeated key are texts of their own with the
    key's label.
    """
    sample = labelled_sample(labels, key, label, settings.max_training)
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    # The sample is bounded by the setting, so it is broadcast and texts are not shuffled.
    rows = texts.join(F.broadcast(sample.withColumnRenamed(key, "_key")), "_key")

    def all_features():
        return lambda value: (list(features_of(words_of(value or ""))),)

    every = add_columns(rows, "_text", "_features array<string>", all_features)
    counts = every.select("_label", F.explode("_features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").cast("double").alias("k"))
    total, positive = rows.agg(F.count(F.lit(1)), F.sum("_label")).first()
    if not total or not positive or positive == total:
        share = ((positive or 0) + 0.5) / (total + 1)
        return Model(math.log(share / (1 - share)), {})

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, k, p = F.col("n"), F.col("k"), positive / total
    without, rest = total - n, positive - k
    gain = 2 * (
        part(k, n * p)
        + part(n - k, n * (1 - p))
        + part(rest, F.greatest(without * p, F.lit(1e-9)))
        + part(without - rest, F.greatest(without * (1 - p), F.lit(1e-9)))
    )
    chosen = (
        counts.where("n >= 3")
        .select("feature", gain.alias("gain"))
        .where(F.col("gain") >= settings.least_gain)
        .orderBy(F.desc("gain"), "feature")
        .limit(settings.max_features)
    )
    vocabulary = {row.feature: i for i, row in enumerate(chosen.collect())}
    neutral = counts.where(~F.endswith("feature", F.lit("*"))).where(
        (n >= 5) & (n <= max(5, settings.neutral_share * total)) & (k <= n * p) & F.col("feature").rlike("^[^0-9_]{3,}$")
    )
    found = neutral.orderBy((n - k).desc(), "feature").limit(settings.neutral_terms).collect()
    terms, size = [row.feature for row in found], settings.neutral_group
    groups = "\n".join(" ".join(terms[i : i + size]) for i in range(0, len(terms), size))
    swap = next_terms(groups) | next_terms(settings.identity)

    def chosen_features():
        def work(value):
            words = words_of(value or "")
            swapped = {swap.get(word, word) for word in words}
            changed = swapped != words
            mine = [vocabulary[f] for f in features_of(words) if f in vocabulary]
            other = [vocabulary[f] for f in features_of(swapped) if f in vocabulary] if changed else None
            return sorted(mine), sorted(other) if changed else None

        return work

    made = add_columns(rows, "_text", "_own array<int>, _swapped array<int>", chosen_features)
    data = made.select("_label", "_own", "_swapped").collect()  # bounded by max_training
    data.sort(key=lambda row: (row._own, row._label))
    pairs = [(row._own, row._swapped) for row in data if row._swapped is not None]
    bias, weights = regression(
        [row._own for row in data], np.array([row._label for row in data], float), pairs, len(vocabulary), settings
    )
    return Model(bias, {feature: float(weights[i]) for feature, i in vocabulary.items()}, len(pairs))


def _sparse(rows: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    place = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return place, np.array([i for r in rows for i in r], int)


def regression(
    rows: Sequence[Sequence[int]],
    labels: np.ndarray,
    pairs: Sequence[tuple[Sequence[int], Sequence[int]]],
    n_features: int,
    settings: Settings,
) -> tuple[float, np.ndarray]:
    """Full-batch Adam on logistic loss, ridge and counterfactual penalty."""
    place, column = _sparse(rows)
    own_place, own = _sparse([a for a, _ in pairs])
    swap_place, swapped = _sparse([b for _, b in pairs])
    n, m = len(rows), max(len(pairs), 1)
    share = labels.mean()
    x = np.zeros(n_features + 1)
    x[-1] = math.log(share / (1 - share))
    first, second = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, settings.rounds + 1):
        w = x[:-1]
        logit = np.bincount(place, w[column], n).astype(float) + x[-1]
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / n
        gradient = np.append(np.bincount(column, error[place], n_features) + settings.ridge * w, error.sum())
        if pairs:
            # Sums of nothing come as whole numbers.
            sides = (np.bincount(own_place, w[own], len(pairs)), np.bincount(swap_place, w[swapped], len(pairs)))
            change = sides[0].astype(float) - sides[1]
            change *= settings.counterfactual / m
            for side, rows_of, sign in ((own, own_place, 1.0), (swapped, swap_place, -1.0)):
                gradient[:-1] += sign * np.bincount(side, change[rows_of], n_features)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        x -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    return float(x[-1]), x[:-1]


class Scorer(dict):
    """Maps a word to those of its features the model uses; remembers the words it has seen."""

    REMEMBERED = 150_000

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> tuple[str, ...]:
        used = tuple(f for f in word_features(word) if f in self.model.weights)
        if len(self) < self.REMEMBERED and len(word) <= LONGEST_WORD:
            self[word] = used
        return used

    def score(self, text: str | None) -> float:
        found: set[str] = set()
        for used in map(self.__getitem__, words_of(text or "")):
            if used:
                found.update(used)
        logit = math.fsum([self.model.bias, *(self.model.weights[f] for f in found)])
        return 1 / (1 + math.exp(-max(min(logit, 700.0), -700.0)))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``: 0 to 1, the likelihood of the label. Null and empty texts get the model's
    bias. Other columns are kept; the text alone is looked at. No shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by max_features

    def make():
        scorer = Scorer(shared.value)
        return lambda value: (scorer.score(value),)

    return add_columns(df, text, f"`{out}` double", make)
