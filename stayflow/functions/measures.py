"""Comparison, counting and banding expressions used by merges and marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business thresholds. Tiers are tried from the top.
TIER_FLOORS = (("platinum", 50000), ("gold", 20000), ("silver", 5000))
LOWEST_TIER = "bronze"
BAND_REVENUE_FLOOR = 520000
BAND_RATING_FLOOR = 3.0
# Band names by (revenue reaches floor, rating reaches floor).
BANDS = {
    (True, True): "Top Performer",
    (True, False): "At Risk",
    (False, True): "Hidden Gem",
    (False, False): "Needs Attention",
}
UNCLASSIFIED = "Unclassified"


def changed(left: str, right: str, cols: Sequence[str]) -> Column:
    """True where any column differs between the two aliases; two NULLs are equal."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols],
    )


def same(left: str, right: str, cols: Sequence[str], null_safe: bool = True) -> Column:
    """True where all columns agree. Without ``null_safe`` a NULL agrees with nothing."""

    def pair(c: str) -> Column:
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, [pair(c) for c in cols])


def count_when(condition: Column) -> Column:
    """Rows where ``condition`` holds, as an aggregate; NULL counts as no, never as NULL."""
    return F.sum(F.when(condition, 1).otherwise(0))


def label_is(c: Column, label: str) -> Column:
    return F.lower(c) == label


def ratio(total: Column, n: Column) -> Column:
    """``total / n`` as double, NULL for ``n = 0``. Inputs are exact sums and counts, so the
    result does not depend on the order rows were added in."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal, rounded half up in exact arithmetic."""
    share = F.try_divide(part.cast("decimal(19,0)") * 100, whole.cast("decimal(19,0)"))
    return F.round(share, 1).cast("double")


def customer_tier(lifetime_value: Column) -> Column:
    tier = F.lit(LOWEST_TIER)
    for name, floor in reversed(TIER_FLOORS):
        tier = F.when(lifetime_value >= floor, F.lit(name)).otherwise(tier)
    return tier


def performance_band(revenue: Column, rating: Column) -> Column:
    """Revenue and rating against their floors; a hotel lacking either is unclassified."""
    rich, liked = revenue >= BAND_REVENUE_FLOOR, rating >= BAND_RATING_FLOOR
    band = F.when(revenue.isNull() | rating.isNull(), F.lit(UNCLASSIFIED))
    for (is_rich, is_liked), name in BANDS.items():
        band = band.when((rich == is_rich) & (liked == is_liked), F.lit(name))
    return band
