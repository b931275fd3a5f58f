"""Numbers from text, and percentages that are exact in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """A double from text with thousands commas and a Rs. mark, null for anything that is not a plain number."""
    v = F.trim(F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit("Rs."), F.lit("")))
    return F.when(v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), v.try_cast("double"))


def whole(c: Column) -> Column:
    """Cut to a bigint."""
    return c.cast("bigint")


#: Products of bigints and the factor of percentages.
WIDE = "decimal(28,0)"


def exact_pct(a: Column, b: Column) -> Column:
    """100 * a / b of bigints to two places, halves away from zero, by integer arithmetic; null where b is 0 or null.

    Exact for all bigints (the last step, a division by 100, is in doubles); the sign takes in the denominator's.
    """
    a, b = a.cast("bigint"), F.nullif(b.cast("bigint"), F.lit(0).cast("bigint"))
    size_of = lambda c: F.abs(c.cast(WIDE))
    # (2 * 10000 |a| + |b|) // (2 |b|): hundredths of a percent, rounded half up.
    over, under = (size_of(a) * 20000 + size_of(b)).cast(WIDE), (size_of(b) * 2).cast(WIDE)
    hundredths = ((over - over % under) / under).cast(WIDE).cast("double")
    return F.when(F.signum(a.cast("double")) * F.signum(b.cast("double")) < 0, -hundredths).otherwise(hundredths) / 100.0
