"""Every schema of the library, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

# The field names and types of a yellow-cab trip record, in wire order.
TRIP_WIRE = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.StringType()),
        T.StructField("tpep_dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)

# Shape of a Kafka record, also used for a topic kept as a folder of Parquet files.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType(
                    [T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]
                )
            ),
        ),
    ]
)

ZONE = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Zone", T.StringType()),
    ]
)

# Two trips are the same event when these seven fields agree. The two
# amounts lead because grouping sorts by this order, and they differ most between trips.
TRIP_KEY = [
    "fare_amount",
    "trip_distance",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "VendorID",
    "PULocationID",
    "DOLocationID",
]

# What silver needs of a trip beside its key; no other field enters the shuffle.
TRIP_REST = ["payment_type", "passenger_count", "tip_amount", "total_amount"]

# The published silver columns.
SILVER = T.StructType(
    [
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("pickup_datetime", T.TimestampType()),
        T.StructField("dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("pickup_zone", T.StringType()),
        T.StructField("dropoff_zone", T.StringType()),
        T.StructField("trip_duration_minutes", T.DoubleType()),
        T.StructField("trip_speed_kmh", T.DoubleType()),
    ]
)

# The published gold columns.
GOLD = T.StructType(
    [
        T.StructField("pickup_zone", T.StringType()),
        T.StructField("avg_speed_kmh", T.DoubleType()),
        T.StructField("max_speed_kmh", T.DoubleType()),
    ]
)

# One row per published version of a full-refresh table.
COMMIT_LOG = T.StructType(
    [
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


def ddl_columns(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE statement for ``schema``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema)
