"""Number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage, null when the whole is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def round_half_even(col: Column, digits: int = 0) -> Column:
    return F.bround(col, digits)


def clamp(col: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))


# Numeric rank of a severity.
SEVERITY_VALUES = {"low": 1.0, "medium": 2.0, "high": 3.0, "critical": 4.0}


def severity_value(col: Column) -> Column:
    from .text import lookup

    return lookup(col, SEVERITY_VALUES, 1.0)


def risk_level(score: Column) -> Column:
    """Band of a 0..100 score."""
    return (
        F.when(score >= 80, "critical").when(score >= 60, "high").when(score >= 35, "medium").otherwise("low")
    )


def call_cost_usd(tokens_in: Column, tokens_out: Column, rate_in: Column, rate_out: Column) -> Column:
    """Price of one call; rates are per million tokens."""
    return F.round((tokens_in * rate_in + tokens_out * rate_out) / F.lit(1_000_000), 6)
