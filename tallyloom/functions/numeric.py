"""Arithmetic helpers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_pct(part: Column, whole: Column, scale: int = 100) -> Column:
    """``part / whole * scale``; NULL instead of an error when ``whole`` is zero."""
    return part / F.nullif(whole, F.lit(0)) * scale


def mean(column: Column | str) -> Column:
    """Average as double: an exact sum divided once, so it does not depend on row order."""
    return F.sum(column).cast("double") / F.count(column)


def scaled_estimate(total: Column, rate: str = "0.031") -> Column:
    """A population total times a prevalence rate, in exact decimal arithmetic."""
    return total * F.lit(Decimal(rate))
