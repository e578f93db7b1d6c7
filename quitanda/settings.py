"""Parameters the operators share, and their default values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Period:
    """A closed range of days."""

    first: dt.date
    last: dt.date

    @classmethod
    def of(cls, first: str, last: str) -> "Period":
        return cls(dt.date.fromisoformat(first), dt.date.fromisoformat(last))


@dataclass(frozen=True)
class SegmentLimits:
    """Lowest revenue of each customer segment; below ``top_tier`` is REGULAR."""

    vip: Decimal = Decimal("22000")
    top_tier: Decimal = Decimal("17000")


# Period and limits the marts use unless the caller gives others.
DEFAULT_PERIOD = Period.of("2025-12-13", "2026-01-11")
DEFAULT_LIMITS = SegmentLimits()
