"""Aggregates over the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.exact import exact_mean


def zone_speed(silver: DataFrame) -> DataFrame:
    """Average and maximum speed per pickup zone name; averages do not depend on the rows' order."""
    return (
        silver.filter(F.col("pickup_zone").isNotNull() & F.col("trip_speed_kmh").isNotNull())
        .groupBy("pickup_zone")
        .agg(
            # The names of the published columns, here and in ``speed_stats``.
            exact_mean(F.col("trip_speed_kmh")).alias("avg_speed_kmh"),
            F.max("trip_speed_kmh").alias("max_speed_kmh"),
        )
    )


def speed_stats(silver: DataFrame) -> DataFrame:
    """One row over all trips; over no trips it is null, null, null, 0."""
    speed = F.col("trip_speed_kmh")
    return silver.agg(
        F.max(speed).alias("max_trip_speed_kmh"),
        exact_mean(speed).alias("avg_trip_speed_kmh"),
        F.sum(F.when(speed.isNull(), 1).otherwise(0)).alias("null_speed_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def row_counts(counts: dict[str, DataFrame]) -> DataFrame:
    """Rows of every layer, as ``layer, row_count``, from tables of one ``row_count`` each."""
    named = [one.select(F.lit(name).alias("layer"), "row_count") for name, one in counts.items()]
    return reduce(DataFrame.unionAll, named)


def counted(rows: DataFrame) -> DataFrame:
    """``row_count`` by going through the rows."""
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def column_fill(rows: DataFrame) -> DataFrame:
    """Position, name, type and filled rows of every column, from one aggregate."""
    filled = rows.agg(*(F.count(F.col(f.name)).alias(f.name) for f in rows.schema))
    columns = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("filled_rows"),
        )
        for position, f in enumerate(rows.schema, start=1)
    ]
    return filled.select(F.inline(F.array(*columns)))
