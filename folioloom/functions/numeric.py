"""Numeric expressions that stay NULL, not an error, where a value is undefined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """Quotient; NULL for a zero or NULL denominator (ANSI division would raise)."""
    return num / F.nullif(den, F.lit(0.0))


def positive(col: str) -> Column:
    """Double value when above zero, else NULL."""
    v = F.col(col).cast("double")
    return F.when(v > 0, v)


def strict_least(a: Column, b: Column) -> Column:
    """Smaller of two values, NULL when either is NULL (built-in ``least`` skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate; NULL for one row or a constant series.

    The built-in ``corr`` raises a division error under ANSI when a series is constant, and
    no surrounding guard stops an aggregate from being evaluated. Pairs with a NULL on either
    side are left out of all three terms.
    """
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.covar_samp(xx, yy) / F.nullif(F.stddev_samp(xx) * F.stddev_samp(yy), F.lit(0.0))
