"""Ratios, rounding and correlation with the null rules of the SQL standard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-way cases go away from zero.

    The value passes through eight decimals first: averages of doubles carry noise in
    their last bits that depends on the order of the partial sums, and without this
    step an exact half could round either way from run to run.
    """
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")


def safe_ratio(top: Column, bottom: Column) -> Column:
    """NULL where the divisor is zero."""
    return top / F.nullif(bottom, F.lit(0.0))


def growth_pct(current: Column, baseline: Column) -> Column:
    """Change from ``baseline`` in percent; a zero baseline has no growth."""
    return safe_ratio(100.0 * (current - baseline), baseline)


def share_pct(part: Column, whole: Column) -> Column:
    return safe_ratio(100.0 * part.cast("double"), whole.cast("double"))


def per_million(value: Column, people: Column) -> Column:
    return safe_ratio(value, people.cast("double") / 1000000.0)


def pair_correlation(x: Column, y: Column) -> Column:
    """Pearson's r over the rows where both sides are present; a constant side has no
    correlation (the built-in raises a division error there in ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.sqrt(F.var_pop(F.when(both, x)) * F.var_pop(F.when(both, y)))
    return safe_ratio(F.covar_pop(x, y), spread)
