"""Trip speed.

The column is named ``trip_speed_kmh`` but no unit is converted: distance in miles
gives miles per hour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _moves(minutes: Column, distance: Column) -> Column:
    return (minutes > 0) & (distance > 0)


def trip_speed(minutes: Column, distance: Column) -> Column:
    """Distance per hour of a trip that takes time and covers ground; of others there is none."""
    return F.when(_moves(minutes, distance), distance / (minutes / F.lit(60.0)))


def speed_is_undefined(minutes: Column, distance: Column) -> Column:
    """True where a trip has no speed."""
    return ~F.coalesce(_moves(minutes, distance), F.lit(False))
