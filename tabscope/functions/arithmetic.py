"""Rounding, and percentages that are NULL instead of infinite."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column | str, digits: int) -> Column:
    """Round half up, once.

    A sum or mean of doubles depends in its last bits on the order in which tasks
    add up, and so may a result that lies on a half.
    """
    return F.round(value, digits)


def percent_change(previous: Column, current: Column) -> Column:
    """Change relative to ``previous`` in percent, 2 decimals; NULL on a zero base."""
    return F.when(previous != 0, rounded(100 * (current - previous) / previous, 2))


def percent_difference(difference: Column, first: Column, second: Column) -> Column:
    """``difference`` relative to the mean of the two values; NULL on a zero mean."""
    mean = (first + second) / 2
    return F.when(mean != 0, rounded(100 * difference / mean, 2))
