"""Typing and validity of wire-shaped trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.numbers import nan_to_null, whole_number
from tripstrata.functions.speed import trip_speed
from tripstrata.functions.times import duration_minutes, parse_time
from tripstrata.schemas import TRIP_KEY, TRIP_REST

_AMOUNTS = ["trip_distance", "fare_amount", "tip_amount", "total_amount"]


def needed_fields(trips: DataFrame) -> DataFrame:
    """The fields silver is made of, with NaN as null and whole passengers."""
    return trips.select(*TRIP_KEY, *TRIP_REST).withColumns(
        {
            **{name: nan_to_null(F.col(name)) for name in _AMOUNTS},
            "passenger_count": whole_number(F.col("passenger_count")),
        }
    )


def with_times(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "pickup_ts": parse_time(F.col("tpep_pickup_datetime")),
            "dropoff_ts": parse_time(F.col("tpep_dropoff_datetime")),
        }
    )


def valid_times(trips: DataFrame) -> DataFrame:
    """Trips whose times can both be read and do not run backwards; zero length stays.

    The comparison alone also drops missing times. Asking for them as well would parse
    each text once more.
    """
    return with_times(trips).filter(F.col("dropoff_ts") >= F.col("pickup_ts"))


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "trip_duration_minutes", duration_minutes(F.col("pickup_ts"), F.col("dropoff_ts"))
    )


def with_speed(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "trip_speed_kmh", trip_speed(F.col("trip_duration_minutes"), F.col("trip_distance"))
    )
