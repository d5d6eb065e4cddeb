"""Quality rules: text statistics and an ordered list of threshold conditions learned from labels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.rows import Work

# White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \\t-\\r"
SYMBOLS = "#*$%&|<>"
# From so many repeated shingles on, sorting finds them faster than looking each up.
FEW_REPEATED = 48
FEATURES = (
    "n_words",
    "chars_per_word",
    "symbols_per_word",
    "dup_lines_share",
    "repeat_share",
    "distinct_share",
    "capitals_share",
    "words_per_line",
)


@dataclass(frozen=True)
class Settings:
    """``max_labelled``: labelled rows the list is learned from, the first by a hash of the id.
    ``bins``: thresholds tried per statistic, and ``refinements``: how often as many more are
    tried between the neighbours of the best one. A rule has at most ``max_conditions`` and must
    reach ``least_precision`` on ``least_cover`` rejected rows or more.
    """

    max_labelled: int = 20_000
    bins: int = 24
    refinements: int = 2
    max_rules: int = 8
    max_conditions: int = 3
    least_precision: float = 0.95
    least_cover: int = 5


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Sequence[Condition]) -> Column:
    column = F.lit(True)
    for condition in rule:
        column = column & condition.column()
    return column


def verdict(rules: Sequence[Rule]) -> Column:
    """True unless a rule holds; the rules in their order as one conditional expression."""
    column = F.lit(True)
    for rule in reversed(rules):
        column = F.when(holds(rule), F.lit(False)).otherwise(column)
    return column


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with counts and the ``FEATURES`` made of them.

    Words are stretches without ASCII white space; null texts have none. ``n_repeat_words``
    counts words inside a window of three that is in the text more than once. Everything is
    made within the row: nothing is shuffled, no text leaves the JVM. Columns of these names
    are replaced.
    """
    made = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES)
    kept = [c for c in df.columns if c != text and c not in made]
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    white = F.char_length(F.regexp_replace(body, f"[^{SPACE}]+", ""))
    # The table's own columns are numbered meanwhile, so that they cannot have a name used here.
    number = [f"own {i}" for i in range(len(kept))]
    first = df.select(
        *[F.col(c).alias(n) for c, n in zip(kept, number)],
        words.alias("_words"),
        lines.alias("_lines"),
        (F.char_length(body) - white).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace(body, "[^A-Z]+", "")).cast("long").alias("_capitals"),
    )
    n = F.size("_words")

    def window(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2))

    shingles = F.when(n >= 3, F.transform(F.slice("_words", F.lit(1), n - 2), window))
    second = first.select(
        *number,
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "_capitals",
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("_distinct"),
        shingles.alias("_shingles"),
    )
    ordered = F.when(F.size(F.array_distinct("_shingles")) < F.size("_shingles"), F.sort_array("_shingles"))
    # Each column below is a step of its own, as a lambda would work it out anew per element.
    counted = second.withColumn("_ordered", ordered)
    again = F.filter("_ordered", lambda x, i: x == F.get("_ordered", i - 1))
    counted = counted.withColumn("_twice", F.array_distinct(again))
    placed = F.sort_array(F.transform("_shingles", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    counted = counted.withColumn("_placed", F.when(F.size("_twice") > FEW_REPEATED, placed))

    def has_equal(x: Column, i: Column) -> Column:
        return (x["w"] == F.get("_placed", i - 1)["w"]) | (x["w"] == F.get("_placed", i + 1)["w"])

    places = F.transform(F.filter("_placed", has_equal), lambda x: x["i"])
    counted = counted.withColumn("_places", F.sort_array(places))
    counted = counted.withColumn("n_repeat_words", _repeat_words())
    counted = counted.drop("_shingles", "_ordered", "_twice", "_placed", "_places")
    per_word = F.greatest("n_words", F.lit(1))
    counted = counted.withColumns(
        {
            "chars_per_word": F.col("word_chars") / per_word,
            "symbols_per_word": F.col("n_symbols") / per_word,
            "dup_lines_share": F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1)),
            "repeat_share": F.col("n_repeat_words") / per_word,
            "distinct_share": F.col("_distinct") / per_word,
            "capitals_share": F.col("_capitals") / F.greatest("word_chars", F.lit(1)),
            "words_per_line": F.col("n_words") / F.greatest("_n_lines", F.lit(1)),
        }
    ).drop("_n_lines", "_distinct", "_capitals")
    return counted.withColumnsRenamed(dict(zip(number, kept)))


def _repeat_words() -> Column:
    """Words covered by windows that are in ``_twice``.

    With few of them each window is looked up, and one number carries four times the words
    covered so far plus the words the last window still covers. With many, the windows had been
    sorted with their places, which costs less than looking up; both give the same count.
    """
    most = 3

    def step(state: Column, window: Column) -> Column:
        left = F.pmod(state, F.lit(4))
        going_on = F.when(left > 0, state + 3).otherwise(state)
        return F.when(F.array_contains("_twice", window), state - left + 6).otherwise(going_on)

    state = F.aggregate("_shingles", F.lit(0).cast("long"), step)
    state = F.when(F.size("_twice") <= FEW_REPEATED, state)
    looked_up = F.aggregate(F.array(state), F.lit(0).cast("long"), lambda _, x: F.shiftright(x, 2) + F.pmod(x, F.lit(4)))

    def new_words(place: Column, i: Column) -> Column:
        after = F.coalesce(F.get("_places", i + 1), place + most)
        return F.least(F.lit(most), after - place)

    sorted_out = F.aggregate(F.transform("_places", new_words), F.lit(0).cast("long"), lambda s, x: s + x)
    # Not deterministic in Spark's eyes for the last part, so a filter on the statistics is not
    # moved below this step, where it would repeat all the steps inside each other's lambdas.
    return F.coalesce(sorted_out, looked_up, F.spark_partition_id() * 0).cast("long")


def labelled_sample(labels: DataFrame, key: str, label: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled keys, in the order of a hash; of several labels the least counts."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    parts, order = 1 << 30, F.xxhash64(key)
    share = min(1.0, 1.2 * bound / max(known.count(), 1))
    picked = known.where(F.pmod(order, F.lit(parts)) < F.lit(int(share * parts)))
    single = picked.groupBy(key).agg(F.min(label).alias("_label"))
    return single.orderBy(F.xxhash64(key), key).limit(bound)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    where: Column | None = None,
    settings: Settings = Settings(),
) -> list[Rule]:
    """Rules for rows to reject (label 0), best first, by sequential covering.

    A rule grows on two thirds of the labelled rows: the condition of largest information
    gain joins until no good row is left. It is then cut back to the conditions that do best on
    the other third, and kept if precise enough on both. Rows it covers are left out before the
    next one. Every choice is made from counts per statistic, bin and label that Spark sums
    up; the driver sees only those. ``where`` restricts the rows learned from. Without labels of
    both kinds there are no rules.
    """
    work = Work(docs.sparkSession)
    sample = F.broadcast(labelled_sample(labels, key, label, settings.max_labelled))  # bounded
    rows = docs.select(key, text).join(sample, key)
    stats = with_statistics(rows, text)
    stats = stats if where is None else stats.where(where)
    is_bad, grows = (F.col("_label") == 0).alias("bad"), (F.pmod(F.xxhash64(key), F.lit(3)) > 0).alias("grow")
    stats = work.store(stats.select(is_bad, grows, *[F.col(f).cast("double").alias(f) for f in FEATURES]), "stats")
    steps = [i / settings.bins for i in range(1, settings.bins)]
    bad_cuts = stats.where("bad").agg(*[F.percentile_approx(f, steps, 2000).alias(f) for f in FEATURES]).first()
    cuts = stats.agg(*[F.percentile_approx(f, steps, 2000).alias(f) for f in FEATURES]).first()
    thresholds = {f: sorted({*(cuts[f] or []), *(bad_cuts[f] or [])}) for f in FEATURES}
    stats = work.store(stats.select("*", *[_bin(f, thresholds[f]) for f in FEATURES]), "bins")
    rules: list[Rule] = []
    while len(rules) < settings.max_rules:
        left = stats.where(verdict(rules))
        rule = _grow(left.where("grow"), thresholds, settings)
        rule = _prune(left.where(~F.col("grow")), rule)
        if not rule:
            break
        bad, good = _cover(left, [rule])[0]
        if bad < settings.least_cover or bad < settings.least_precision * (bad + good):
            break
        rules.append(rule)
    return rules


def _bin(feature: str, thresholds: list[float]) -> Column:
    """The number of thresholds below the value."""
    known = F.array(*map(F.lit, thresholds)).cast("array<double>")
    return F.size(F.filter(known, lambda t: t < F.col(feature))).alias(f"bin_{feature}")


def _cover(rows: DataFrame, rules: Sequence[Sequence[Condition]]) -> list[tuple[int, int]]:
    """Bad and good rows under each of a few rules."""
    sums = []
    for rule in rules:
        sums += [F.count_if(holds(rule) & F.col("bad")), F.count_if(holds(rule) & ~F.col("bad"))]
    row = rows.agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first()
    return [(row[i], row[i + 1]) for i in range(0, len(sums), 2)]


def _grow(rows: DataFrame, thresholds: dict[str, list[float]], settings: Settings) -> Rule:
    rule: list[Condition] = []
    while len(rule) < settings.max_conditions:
        bins = [F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in FEATURES]
        covered = rows.where(holds(rule)).select("bad", F.inline(F.array(*bins)))
        counts = covered.groupBy("feature", "bin", "bad").count().collect()  # features x bins x 2
        best = _best(counts, thresholds)
        if best is None:
            break
        best = _refined(rows.where(holds(rule)), best, thresholds[best[0].feature], settings)
        rule.append(best[0])
        if best[1] == 0:
            break
    return tuple(rule)


def _refined(
    covered: DataFrame, best: tuple[Condition, int], cuts: list[float], settings: Settings
) -> tuple[Condition, int]:
    """The condition with the best threshold between the cuts on either side of its own, moved
    to the middle between the value found and the next one, as far as can be from both."""
    feature = best[0].feature
    steps = [i / settings.bins for i in range(1, settings.bins)]
    for _ in range(settings.refinements):
        at = cuts.index(best[0].threshold)
        sides = cuts[max(0, at - 1) : at + 2]
        low, high = sides[0], sides[-1]
        near = covered.where((F.col(feature) >= low) & (F.col(feature) <= high))
        found = near.agg(F.percentile_approx(feature, steps, 2000).alias("cuts")).first().cuts
        cuts = sorted({*(found or []), *sides})
        if len(cuts) == len(sides):
            break
        counts = covered.select("bad", F.lit(feature).alias("feature"), _bin(feature, cuts).alias("bin"))
        best = _best(counts.groupBy("feature", "bin", "bad").count().collect(), {feature: cuts}) or best
    condition, good = best
    after = covered.where(F.col(feature) > condition.threshold).agg(F.min(feature).alias("value")).first().value
    middle = condition.threshold if after is None else (condition.threshold + after) / 2
    return Condition(feature, condition.above, middle), good


def _best(counts: list, thresholds: dict[str, list[float]]) -> tuple[Condition, int] | None:
    """The condition of largest gain, with the good rows it still covers."""
    table = {f: [[0, 0] for _ in range(len(t) + 1)] for f, t in thresholds.items()}
    for row in counts:
        table[row.feature][row.bin][row.bad] += row["count"]
    best, gain = None, 1e-9
    for feature, bins in table.items():
        all_good, all_bad = (sum(b[k] for b in bins) for k in (0, 1))
        if not all_bad or not all_good:
            continue
        before = math.log2(all_bad / (all_bad + all_good))
        good = bad = 0
        for threshold, (g, b) in zip(thresholds[feature], bins):
            good, bad = good + g, bad + b
            for above, p, n in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                now = p * (math.log2(p / (p + n)) - before) if p else 0
                if now > gain:
                    best, gain = (Condition(feature, above, threshold), n), now
    return best


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of the rule with the best balance of bad against good rows."""
    starts = [rule[:n] for n in range(1, len(rule) + 1)]
    if not starts:
        return rule
    worth = [(bad - good) / (bad + good) if bad + good else -1.0 for bad, good in _cover(rows, starts)]
    return starts[worth.index(max(worth))] if max(worth) > -1.0 else rule
