"""Zone names by location id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.sources.session import broadcast_limit, scan_bytes

#: An id with more than this share of the trips is hot; there are fewer than its inverse.
HOT_SHARE = 0.01


def zone_names(zones: DataFrame) -> DataFrame:
    """The lookup with one name per id, so that a join can never multiply trips."""
    return zones.groupBy("LocationID").agg(F.min("Zone").alias("Zone"))


def with_zone(trips: DataFrame, zones: DataFrame, id_column: str, zone_column: str) -> DataFrame:
    """Add the zone name of ``id_column``; trips without a match keep a null name.

    There is no broadcast hint: Spark broadcasts a lookup below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    role = _role(zone_names(zones), zone_column)
    return trips.join(role, F.col(id_column) == F.col("_zone_id"), "left").drop("_zone_id")


def _role(names: DataFrame, zone_column: str) -> DataFrame:
    return names.select(F.col("LocationID").alias("_zone_id"), F.col("Zone").alias(zone_column))


def hot_ids(trips: DataFrame, id_column: str, parts: int) -> dict[int, int]:
    """Ids that hold a large share of the trips, and the parts that each should be dealt into.

    An id gets as many as its trips would fill of ``parts`` equal ones. Counting has a
    map-side part, and fewer ids than 1 / ``HOT_SHARE`` can be hot.
    """
    total = trips.count()
    counts = trips.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).count()
    hot = counts.where(F.col("count") > total * HOT_SHARE)
    return {r.id: max(2, math.ceil(r["count"] / total * parts)) for r in hot.collect()}


def _salt(trips: DataFrame, id_column: str, hot: dict[int, int], parts: int) -> Column:
    """Which of its id's parts a trip belongs to, by all of its fields."""
    spread = F.xxhash64(*trips.columns)
    salt = F.when(F.col(id_column).isNull(), F.pmod(spread, F.lit(parts)))
    for zone_id, n in sorted(hot.items()):
        salt = salt.when(F.col(id_column) == zone_id, F.pmod(spread, F.lit(n)))
    return salt.otherwise(0).cast("int")


def with_zone_salted(
    trips: DataFrame, zones: DataFrame, id_column: str, zone_column: str, hot: dict[int, int], parts: int
) -> DataFrame:
    """As ``with_zone`` for a lookup too large to be broadcast, whatever share an id holds.

    Trips of a hot id, and those without one, are dealt into several parts; the names of hot
    ids are repeated for each of these parts, other names are not. Copies of one trip stay in
    one part; these, adaptive execution splits.
    """
    copies = F.lit(1)
    for zone_id, n in sorted(hot.items()):
        copies = F.when(F.col("_zone_id") == zone_id, n).otherwise(copies)
    # Names are dealt out off the key first: no aggregate may stand between exchange and join
    # where adaptive execution is to split a part.
    role = _role(zone_names(zones).repartition(parts), zone_column).withColumn(
        "_zone_salt", F.explode(F.sequence(F.lit(0), copies - 1))
    )
    salted = trips.withColumn("_salt", _salt(trips, id_column, hot, parts))
    same = (F.col(id_column) == F.col("_zone_id")) & (F.col("_salt") == F.col("_zone_salt"))
    return salted.join(role, same, "left").drop("_zone_id", "_zone_salt", "_salt")


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Add ``pickup_zone`` and ``dropoff_zone``.

    A lookup that Spark would broadcast is joined as it is, in the stage of the trips. For a
    larger one the hot ids of both roles are counted first, which are two short jobs.
    """
    roles = {"PULocationID": "pickup_zone", "DOLocationID": "dropoff_zone"}
    spark = trips.sparkSession
    if scan_bytes(zones) <= broadcast_limit(spark):
        for id_column, zone_column in roles.items():
            trips = with_zone(trips, zones, id_column, zone_column)
        return trips
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = {id_column: hot_ids(trips, id_column, parts) for id_column in roles}
    for id_column, zone_column in roles.items():
        trips = with_zone_salted(trips, zones, id_column, zone_column, hot[id_column], parts)
    return trips
