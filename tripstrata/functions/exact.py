"""Means that do not depend on the order in which values are added.

A sum of doubles changes with the order of its terms, and Spark adds them in none. Here a
value is split, without rounding, into a whole number and three more of 22 binary places
each. Whole numbers add up the same in any order; the mean comes from their sums by division
with remainder. Places beyond the 66th are cut off for each value, which values from 2**-13
on do not have. Sums hold 2**40 values below 2**22. Where a value is too large to be split
(2**40) or not finite, the plain mean is given.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEP = 1 << 22
LARGEST = float(1 << 40)
PIECES = 4


def _pieces(value: Column) -> list[Column]:
    """The whole part of a value and its places by 22, as whole numbers."""
    # A value beyond the bound is not split, so that its pieces cannot overflow.
    rest = F.when(F.abs(value) < LARGEST, value)
    out = []
    for _ in range(PIECES):
        out.append(F.floor(rest))
        rest = (rest - F.floor(rest)) * F.lit(float(STEP))
    return out


def exact_mean(value: Column) -> Column:
    """Mean of the values that are not null, the same for every order; null for none."""
    n = F.count(value)
    sums = [F.sum(piece) for piece in _pieces(value)]
    quotients, rest = [], F.lit(0).cast("long")
    for total in sums:
        rest = rest * STEP + total
        quotients.append(_div(rest, n))
        rest = rest - quotients[-1] * n
    whole, first, second, third = quotients
    low = second * F.lit(float(STEP) ** -2) + third * F.lit(float(STEP) ** -3)
    mean = whole + (first * F.lit(float(STEP) ** -1) + low)
    fits = F.max(F.abs(value)) < LARGEST
    return F.when(n > 0, F.when(fits, mean).otherwise(F.avg(value)))


def _div(a: Column, b: Column) -> Column:
    """Whole quotient, null for a divisor of 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))
