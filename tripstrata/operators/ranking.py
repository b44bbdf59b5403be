"""Top-k reports and samples. What is ordered runs as a per-task top-k, never as a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fields of a sampled trip.
SAMPLE_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "total_amount",
]


def top_zones(gold: DataFrame, n: int = 10) -> DataFrame:
    """Fastest zones; the name breaks ties."""
    return gold.orderBy(F.col("max_speed_kmh").desc(), "pickup_zone").limit(n)


def latest_commits(history: DataFrame, n: int = 5) -> DataFrame:
    return (
        history.orderBy(F.col("committed_at").desc(), "snapshot_id")
        .limit(n)
        .select("snapshot_id", "committed_at", "operation")
    )


def trip_sample(bronze: DataFrame, n: int = 10, repeatable: bool = True) -> DataFrame:
    """``n`` trips: the first in a fixed order, or any, which reads no more than it needs."""
    columns = bronze.select(*SAMPLE_COLUMNS)
    return (columns.orderBy(*SAMPLE_COLUMNS) if repeatable else columns).limit(n)
