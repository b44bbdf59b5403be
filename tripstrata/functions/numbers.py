"""Numeric clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    """A missing number may arrive as NaN; NaN would poison every max and avg after it."""
    return F.nanvl(value, F.lit(None).cast("double"))


def whole_number(value: Column) -> Column:
    """Double to int, cutting the fraction; null for NaN and for what does not fit."""
    return value.try_cast("int")
