"""Small hand-made trips."""

from tripstrata.schemas import TRIP_WIRE

DEFAULTS = {
    "VendorID": 1,
    "tpep_pickup_datetime": "2025-01-01T00:00:00",
    "tpep_dropoff_datetime": "2025-01-01T00:30:00",
    "passenger_count": 1.0,
    "trip_distance": 10.0,
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "tip_amount": 2.0,
    "total_amount": 22.0,
}


def trip(**fields):
    values = {**DEFAULTS, **fields}
    return tuple(values.get(name) for name in TRIP_WIRE.names)


def bronze(spark, *rows):
    return spark.createDataFrame([trip(**row) for row in rows], TRIP_WIRE)


def zones(spark, *rows):
    return spark.createDataFrame(list(rows), "LocationID int, Zone string")
