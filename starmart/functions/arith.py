"""Null-safe arithmetic.

Spark runs with ANSI mode on, where a division by zero raises, also for
doubles; ``x / nullif(y, 0)`` therefore becomes a guarded division.  Money is
held as an exact decimal and only turned into a double after summing, so the
float results do not depend on the order in which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)``: NULL when the denominator is 0 or NULL."""
    return F.when(den != 0, num / den)


def pct(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0) * 100``."""
    return safe_div(num, den) * 100
