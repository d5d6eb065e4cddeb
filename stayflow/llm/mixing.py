"""Mixing to target weights: soft domain membership and document rates by least squares."""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.rows import Work, free_name

SPACE = " \\t-\\r"


@dataclass(frozen=True)
class Settings:
    """``max_labelled``: labelled rows the classifier is fitted on, the first by a hash of the
    key. ``markers``: words it looks for. ``max_domains``: more are refused. ``temper``: what
    log odds are divided by, as words of one text are not independent. ``pull``: weight of the
    squared distance of rates from 1. ``exact`` and ``passes``: norm of the projected gradient,
    relative to each domain's tokens, at which the least squares count as solved, and passes
    over the documents after which it is an error. ``steps``: gradient steps a pass to begin with. ``smoothing``: where no targets are
    given they are the present shares to this power. ``keep_all``: raise all totals together
    until no domain has to shrink, with rates of at least 1.
    """

    max_labelled: int = 20_000
    markers: int = 256
    max_domains: int = 64
    temper: float = 4.0
    pull: float = 1e-4
    exact: float = 1e-6
    passes: int = 300
    steps: int = 64
    smoothing: float = 0.7
    keep_all: bool = False


def words_of(text: str) -> Column:
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def labelled_sample(labelled: DataFrame, key: str, domain: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled keys by a hash; of several domains of a key the first by name."""
    known = labelled.where(F.col(key).isNotNull() & F.col(domain).isNotNull())
    parts, order = 1 << 30, F.xxhash64(key)
    share = min(1.0, 1.2 * bound / max(known.count(), 1))
    picked = known.where(F.pmod(order, F.lit(parts)) < F.lit(int(share * parts)))
    single = picked.groupBy(F.col(key).alias("_key")).agg(F.min(F.col(domain).cast("string")).alias("_domain"))
    return single.orderBy(F.xxhash64("_key"), "_key").limit(bound)


@dataclass(frozen=True)
class Domains:
    """Names, log odds without any marker, and what each marker adds to them."""

    names: tuple[str, ...]
    base: tuple[float, ...]
    markers: Mapping[str, tuple[float, ...]]


def fit_domains(docs: DataFrame, labelled: DataFrame, key: str, text: str, domain: str, settings: Settings) -> Domains:
    """Bernoulli naive Bayes over the words that say most about the domain, from the labelled
    table. Only counts per marker and domain come to the driver."""
    sample = F.broadcast(labelled_sample(labelled, key, domain, settings.max_labelled))  # bounded
    rows = docs.select(F.col(key).alias("_key"), words_of(text).alias("words")).join(sample, "_key")
    sizes = {r._domain: r["count"] for r in rows.groupBy("_domain").count().limit(settings.max_domains + 1).collect()}
    if not sizes:
        return Domains((), (), {})
    if len(sizes) > settings.max_domains:
        raise ValueError(f"more than {settings.max_domains} domains")
    names, total = tuple(sorted(sizes)), sum(sizes.values())
    words = rows.select("_domain", F.explode(F.array_distinct("words")).alias("word"))
    counts = [F.count_if(F.col("_domain") == name).alias(f"n{k}") for k, name in enumerate(names)]
    per_word = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *counts).where("n >= 5")

    def gain(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    told = F.lit(0.0)
    for k, name in enumerate(names):
        share = sizes[name] / total
        told = told + gain(F.col(f"n{k}"), F.col("n") * share)
        told = told + gain(sizes[name] - F.col(f"n{k}"), F.greatest((total - F.col("n")) * share, F.lit(1e-9)))
    best = per_word.orderBy(told.desc(), "word").limit(settings.markers).collect()
    base = [math.log(sizes[name] / total) for name in names]
    markers = {}
    for row in best:
        present = [(row[f"n{k}"] + 0.5) / (sizes[name] + 1) for k, name in enumerate(names)]
        base = [b + math.log(1 - p) for b, p in zip(base, present)]
        markers[row.word] = tuple(math.log(p / (1 - p)) for p in present)
    return Domains(names, tuple(base), markers)


def posteriors(docs: DataFrame, domains: Domains, key: str, text: str, settings: Settings, work: Work) -> DataFrame:
    """(key, n_tokens, p0, p1, ...): words of each text and its likelihood of each domain.

    Texts are read once; what is stored of them are the markers found and the number of
    words. Rows of one key are one document, with the sum of their words.
    """
    spark, k = docs.sparkSession, range(len(domains.names))
    words = docs.select(F.col(key).alias("key"), words_of(text).alias("words"))
    known = F.array(*map(F.lit, domains.markers)).cast("array<string>")
    found = work.store(
        words.select("key", F.size("words").cast("long").alias("n"), F.array_intersect("words", known).alias("found")),
        "found",
    )
    weights = [(word, *w) for word, w in domains.markers.items()]
    table = spark.createDataFrame(weights, "word string, " + ", ".join(f"w{i} double" for i in k))
    met = found.select("key", F.explode("found").alias("word")).join(F.broadcast(table), "word")  # bounded
    odds = met.groupBy("key").agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in k])
    sizes = found.groupBy("key").agg(F.sum("n").alias("n_tokens"))
    odds = sizes.join(odds.withColumnRenamed("key", "_key"), F.col("key").eqNullSafe(F.col("_key")), "left")
    logs = [(F.coalesce(f"w{i}", F.lit(0.0)) + domains.base[i]) / settings.temper for i in k]
    logs = odds.select("key", "n_tokens", *[x.alias(f"l{i}") for i, x in enumerate(logs)])
    top = F.greatest(*[F.col(f"l{i}") for i in k], F.lit(float("-inf")))
    powers = logs.select("key", "n_tokens", *[F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in k])
    total = sum((F.col(f"e{i}") for i in k), F.lit(0.0))
    return work.store(powers.select("key", "n_tokens", *[(F.col(f"e{i}") / total).alias(f"p{i}") for i in k]), "soft")


def solved_rates(
    soft: DataFrame, targets: list[float], present: list[float], settings: Settings
) -> tuple[DataFrame, list[float]]:
    """``soft`` with a ``rate``, by accelerated projected gradient steps from 1, and the totals of
    the domains at these rates.

    Least squares: sum over domains of (expected tokens - target)^2 / present tokens, plus the
    pull towards 1 weighted by tokens, over rates of at least 0 (1 with ``keep_all``). In the
    metric of the documents' tokens its curvature is at most 1 + pull, so that step size always
    descends. A gradient step changes the rate of a document by a sum over its memberships that has the same
    factors for all documents, so the steps taken so far are one number z per domain, and the rates are
    1 - (memberships times z), projected onto the allowed ones. One pass over the documents sums up the
    totals and their slope in z, a number per pair of domains; nothing else comes to the driver.

    As long as no rate meets its bound, totals change along that slope, so a pass is good for ``steps``
    gradient steps, accelerated by the last move, which is forgotten whenever it points
    uphill. Where they have crossed bounds and the projected gradient has not become smaller,
    they are taken back and fewer are tried, in the end one, which never fails; otherwise more.
    Rounds end when the projected gradient, the gap between what z would lead to and the totals, is
    at most ``exact`` of each domain.
    """
    used = [i for i, m in enumerate(present) if m > 0]
    pull, least = settings.pull, 1.0 if settings.keep_all else 0.0
    m, wanted = np.array([present[i] for i in used]), np.array([targets[i] for i in used])
    unit = np.sqrt(m)  # z in units in which the curvature is at most 1 + pull
    pairs = [(a, b) for a in range(len(used)) for b in range(a + 1)]

    def rate_at(z: np.ndarray) -> Column:
        terms = (F.col(f"p{i}") * F.lit(-float(x)) for i, x in zip(used, z / unit))
        return F.greatest(sum(terms, F.lit(1.0)), F.lit(least))

    def at(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Totals, gradient and its slope."""
        rows = soft.select(*[f"p{i}" for i in used], "n_tokens", rate_at(z).alias("rate"))
        free = F.when(F.col("rate") > least, F.col("n_tokens")).otherwise(0)
        rows = rows.select("*", (F.col("rate") * F.col("n_tokens")).alias("tokens"), free.alias("free"))
        sums = [F.sum(F.col("tokens") * F.col(f"p{i}")) for i in used]
        sums += [F.sum(F.col("free") * F.col(f"p{used[a]}") * F.col(f"p{used[b]}")) for a, b in pairs]
        found = rows.agg(*[x.alias(f"s{j}") for j, x in enumerate(sums)]).first()
        totals, slope = np.array(found[: len(used)], float), pull * np.eye(len(used))
        for (a, b), x in zip(pairs, found[len(used) :]):
            slope[a, b] = slope[b, a] = slope[a, b] + x / (unit[a] * unit[b])
        return totals, pull * z + (wanted - totals) / unit, slope

    def moved(gradient: np.ndarray, slope: np.ndarray, steps: int) -> np.ndarray:
        here = before = np.zeros(len(used))
        speed = 1.0
        for _ in range(steps):
            now = gradient + slope @ here
            after = here - now / (1 + pull)
            uphill = float(now @ (after - before)) > 0
            faster = 1.0 if uphill else (1 + math.sqrt(1 + 4 * speed * speed)) / 2
            carry = 0.0 if uphill else (speed - 1) / faster
            here, before, speed = after + carry * (after - before), after, faster
        return before

    z, steps, passes = np.zeros(len(used)), settings.steps, 1
    totals, gradient, slope = at(z) if used else (m, m, m)
    while used and np.abs(gradient / unit).max() > settings.exact:
        passes += 1
        if passes > settings.passes:
            raise RuntimeError(f"mixing rates not solved after {settings.passes} passes")
        there = z + moved(gradient, slope, steps)
        found = at(there)
        if steps == 1 or np.linalg.norm(found[1]) < np.linalg.norm(gradient):
            z, (totals, gradient, slope), steps = there, found, min(2 * steps, 16 * settings.steps)
        else:
            steps = max(1, steps // 4)
    reached = [0.0] * len(present)
    for i, x in zip(used, totals):
        reached[i] = float(x)
    return soft.withColumn("rate", rate_at(z)), reached


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    domain: str = "domain",
    settings: Settings = Settings(),
) -> DataFrame:
    """(key, n_tokens, rate, domains) of every key: how often to repeat it so that the expected
    tokens of each domain match ``targets`` (weights by name), and its soft membership.

    ``labelled`` has (key, domain) of some documents. Null and empty texts have no tokens;
    null keys are one document, and so are rows of a repeated key, with the sum of their tokens. Without documents
    the result is empty; without a labelled one there are no domains, and all rates are 1.
    Other columns are left out.
    """
    work = Work(docs.sparkSession)
    names: tuple[str, ...]
    if docs.isEmpty():
        kind = docs.schema[key].dataType.simpleString()
        ddl = f"`{key}` {kind}, n_tokens bigint, rate double, domains map<string,double>"
        return docs.sparkSession.createDataFrame([], ddl)
    model = fit_domains(docs, labelled, key, text, domain, settings)
    names = model.names
    if not names:
        sizes = docs.select(F.col(key).alias("key"), F.size(words_of(text)).cast("long").alias("n"))
        none = F.create_map().cast("map<string,double>").alias("domains")
        per_key = sizes.groupBy("key").agg(F.sum("n").alias("n_tokens"))
        return per_key.select(F.col("key").alias(key), "n_tokens", F.lit(1.0).alias("rate"), none)
    soft = posteriors(docs, model, key, text, settings, work)
    k = range(len(names))
    sums = soft.agg(*[F.sum(F.col("n_tokens") * F.col(f"p{i}")) for i in k]).first()
    present = [float(x or 0.0) for x in sums]
    weights = [targets.get(n, 0.0) for n in names] if targets else [m**settings.smoothing for m in present]
    scale = sum(weights) or 1.0
    weights = [w / scale for w in weights]
    total = sum(present)
    if settings.keep_all:
        total = max((m / w for m, w in zip(present, weights) if w > 0), default=total)
    wanted = [w * total for w in weights]
    rated, reached = solved_rates(soft, wanted, present, settings)
    missed = [f"{n}: {x:.0f} of {t:.0f}" for n, x, t in zip(names, reached, wanted) if abs(x - t) > 0.01 * max(t, 1.0)]
    if missed:
        logging.getLogger(__name__).warning("No rates meet these targets (tokens): %s", ", ".join(missed))
    pairs = [c for i in k for c in (F.lit(names[i]), F.col(f"p{i}"))]
    return rated.select(F.col("key").alias(key), "n_tokens", "rate", F.create_map(*pairs).alias("domains"))


def repeat_by_rate(docs: DataFrame, rates: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` as often as its rate says: the whole part surely, and once more
    with the likelihood of the rest, decided by a hash of the key."""
    own_key, rate = free_name(docs, "rate_key"), free_name(docs, "rate")
    copy = free_name(docs, "copy")
    own = rates.select(F.col(key).alias(own_key), F.col("rate").alias(rate))
    rest = F.pmod(F.xxhash64(F.lit("repeat"), F.col(key)), F.lit(1 << 30)) / (1 << 30)
    copies = F.floor(rate) + F.when(rest < F.col(rate) - F.floor(rate), 1).otherwise(0)
    met = docs.join(own, F.col(key).eqNullSafe(F.col(own_key)))
    made = met.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
    return made.select(*docs.columns)
