"""Prices, revenue and the classes derived from them. All arithmetic is exact decimal."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from quitanda.settings import SegmentLimits

PRICE = "decimal(10,2)"
REVENUE = "decimal(18,2)"

# A product above the limit belongs to the band.
PRICE_BANDS = [(1000, "PREMIUM"), (500, "MEDIO")]
LOWEST_BAND = "BASICO"
# Segments in the order they are tried.
SEGMENTS = ["VIP", "TOP_TIER", "REGULAR"]
# Fixed value: a competitor below this share of our price is suspicious.
SUSPICIOUS_SHARE = Decimal("0.6")
# Fixed value: a price this close to the competitors' mean counts as equal to it.
MEAN_TOLERANCE = Decimal("0.05")


def price(value: Column) -> Column:
    """Any number or text as DECIMAL(10,2); what does not fit becomes NULL."""
    return value.try_cast(PRICE)


def line_revenue(quantity: Column, unit_price: Column) -> Column:
    """Exact; NULL where the product does not fit, which an expectation marks."""
    return (quantity * unit_price).try_cast(REVENUE)


def bucketize(value: Column, steps: Sequence[tuple], default: str, strict: bool = True) -> Column:
    """First label whose limit lies below ``value`` (or equals it, if not ``strict``)."""
    label = F.lit(default)
    for limit, name in reversed(steps):
        limit = F.lit(limit)
        label = F.when(value > limit if strict else value >= limit, F.lit(name)).otherwise(label)
    return label


def price_band(value: Column) -> Column:
    """A NULL price falls into the lowest band; the expectation on prices marks it."""
    return bucketize(value, PRICE_BANDS, LOWEST_BAND)


def segment(revenue: Column, limits: SegmentLimits) -> Column:
    vip, top_tier, regular = SEGMENTS
    return bucketize(revenue, [(limits.vip, vip), (limits.top_tier, top_tier)], regular, strict=False)


def suspicious(competitor: Column, own: Column) -> Column:
    """Strictly below 60% of our price; False where either price is unknown."""
    return F.coalesce(competitor < own * F.lit(SUSPICIOUS_SHARE), F.lit(False))


def gap_percent(own: Column, other: Column) -> Column:
    """How far ``own`` lies above ``other``, in percent of ``other``; NULL if that is 0 or unknown."""
    return F.round(F.try_divide(own - other, other) * 100, 2)


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """Exact quotient of two counts or sums, rounded half up; NULL for an empty whole."""
    wide = "decimal(20,2)"
    return F.round(F.try_divide(part.cast(wide), whole.cast(wide)), places)


def price_position(own: Column, low: Column, high: Column, mean: Column, competitors: Column) -> Column:
    """Where our price stands. Being beyond every competitor wins over being close to their mean."""
    distance = F.abs(F.try_divide(own - mean, mean))
    return (
        F.when(competitors == 0, "NA_MEDIA")
        .when(own > high, "MAIS_CARO_QUE_TODOS")
        .when(own < low, "MAIS_BARATO_QUE_TODOS")
        .when(distance < F.lit(MEAN_TOLERANCE), "NA_MEDIA")
        .when(own > mean, "MAIS_CARO_QUE_MEDIA")
        .otherwise("MAIS_BARATO_QUE_MEDIA")
    )
