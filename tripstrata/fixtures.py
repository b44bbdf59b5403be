"""Trips and zones derived from the TPC-H-like test tables.

An order line is a trip: the customer's nation is the pickup place, the supplier's the
drop-off. Missing and unreadable times, negative and zero durations, zero and missing
distances, unknown zones, two zones of one name and exact copies are worked in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.functions.times import ISO_SECONDS
from tripstrata.schemas import TRIP_WIRE
from tripstrata.sources.session import spread_small_scan
from tripstrata.sources.workspace import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _number(value: float) -> Column:
    return F.lit(float(value))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: ids 22 to 24 are missing, ids 3 and 4 share one name."""
    return (
        _table(spark, sf_dir, "nation")
        .filter("n_nationkey < 22")
        .select(
            F.col("n_nationkey").alias("LocationID"),
            F.expr("CASE WHEN n_nationkey = 4 THEN 'NATION_3' ELSE n_name END").alias("Zone"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with both places. Catalyst picks the join strategy from the sizes.

    Orders meet their customers first: where both joins shuffle, the lines move once for them.
    """
    lineitem = spread_small_scan(spark, _table(spark, sf_dir, "lineitem"), "l_orderkey")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lineitem.join(
            orders.join(customer, F.col("o_custkey") == F.col("c_custkey")),
            F.col("l_orderkey") == F.col("o_orderkey"),
        ).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )


# How often a line occurs as a trip: once in the base, and every tenth order once more.
_OCCURRENCES = {
    "base": "array(0)",
    "copies": "array(1)",
    "all": "filter(array(0, 1), c -> c = 0 OR l_orderkey % 10 = 0)",
}


def _occurrences(lines: DataFrame, part: str) -> DataFrame:
    """Repeat lines inside their task, so the joins run once and not once per copy."""
    if part == "base":
        return lines
    if part == "copies":
        # Here, and not in the array, so that it reaches the scan.
        lines = lines.where("l_orderkey % 10 = 0")
    return lines.withColumn("copy", F.explode(F.expr(_OCCURRENCES[part])))


def trips(spark: SparkSession, sf_dir: str, part: str = "all") -> DataFrame:
    """Wire-shaped trips: the ``base``, the ``copies`` or ``all`` of them."""
    pickup = F.date_format("o_orderdate", ISO_SECONDS)
    dropoff = F.date_format(
        F.expr(
            "timestampadd(SECOND, l_suppkey % 60,"
            " timestampadd(MINUTE, l_partkey % 60 - 5, o_orderdate))"
        ),
        ISO_SECONDS,
    )
    fields = {
        "VendorID": F.col("l_linenumber"),
        "tpep_pickup_datetime": F.when(F.expr("l_partkey % 97 = 0"), F.lit(None))
        .when(F.expr("l_partkey % 89 = 0"), F.lit("not-a-time"))
        .otherwise(pickup),
        "tpep_dropoff_datetime": dropoff,
        "passenger_count": F.expr("CASE WHEN l_partkey % 41 <> 0 THEN 1 + l_suppkey % 6 END"),
        "trip_distance": F.when(F.expr("l_partkey % 83 = 0"), _number(0))
        .when(F.expr("l_partkey % 79 = 0"), F.lit(None))
        .otherwise(F.col("l_quantity") / _number(4)),
        "RatecodeID": _number(1),
        "store_and_fwd_flag": F.lit("N"),
        "PULocationID": F.col("c_nationkey"),
        "DOLocationID": F.col("s_nationkey"),
        "payment_type": F.expr("1 + l_linenumber % 4"),
        "fare_amount": F.col("l_extendedprice"),
        "extra": _number(0),
        "mta_tax": _number(0.5),
        "tip_amount": F.col("l_discount"),
        "tolls_amount": _number(0),
        "improvement_surcharge": _number(1),
        "total_amount": F.col("l_extendedprice") + F.col("l_discount"),
        "congestion_surcharge": _number(2.5),
        "Airport_fee": _number(0),
        "cbd_congestion_fee": _number(0.75),
    }
    return _occurrences(_lines(spark, sf_dir), part).select(
        *(fields[f.name].cast(f.dataType).alias(f.name) for f in TRIP_WIRE)
    )


_stored: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a data set that ``write`` derives from all the tables, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = new_folder(spark, name)
        write(path)
        _stored[key] = path
    return _stored[key]


def stored_trips(spark: SparkSession, sf_dir: str, part: str = "all") -> str:
    """Path of the trips as a Parquet table."""
    return stored(spark, sf_dir, f"trips-{part}", trips(spark, sf_dir, part).write.parquet)


def trip_file_columns(wire: DataFrame) -> DataFrame:
    """Wire-shaped trips with real timestamps, as a trip file has them."""
    times = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return wire.withColumns({name: F.try_to_timestamp(name) for name in times})


def write_in_order(rows: DataFrame, path: str) -> None:
    """Write rows to Parquet so that reading files and rows in order gives them sorted.

    The range partitions also split on a random salt: equal rows may sit in any order,
    and so a third of all rows being copies of one does not make one huge partition.
    Part files are named by a five-digit number, which holds up to 99,999 partitions.
    """
    order = rows.columns
    (
        rows.withColumn("_salt", F.rand(7))
        .repartitionByRange(*order, "_salt")
        .sortWithinPartitions(*order)
        .drop("_salt")
        .write.parquet(path)
    )
