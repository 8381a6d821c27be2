"""Percentages and grades that are safe on empty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_pct(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two decimals; 100 when there is nothing to score."""
    share = F.round(F.try_divide(part, whole) * 100, 2)
    return F.when(whole <= 0, F.lit(100.0)).otherwise(share)


def rate_pct(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; NULL when ``whole`` is zero."""
    return F.try_divide(part, whole) * 100


def grade(score: Column) -> Column:
    """Traffic-light grade of an overall score."""
    return F.when(score >= 95, "green").when(score >= 80, "amber").otherwise("red")


def rounded_mean(column: str, digits: int) -> Column:
    """Aggregate: the mean, rounded half-up.

    The order in which partitions add up doubles shifts the last bits of a
    mean; where it sits on a rounding edge that would decide the result.  The
    noise is rounded off first, so reruns agree.
    """
    return F.round(F.round(F.avg(column), 9), digits)
