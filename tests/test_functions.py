"""Column functions on edge values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tripstrata.functions.events import event_key, event_partition, parse_event
from tripstrata.functions.numbers import nan_to_null, whole_number
from tripstrata.functions.speed import speed_is_undefined, trip_speed
from tripstrata.functions.times import duration_minutes, iso_text, parse_time
from tripstrata.schemas import TRIP_WIRE, ddl_columns


def one(frame):
    return [row[0] for row in frame.collect()]


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_times_that_cannot_be_read_are_null(spark, ansi):
    texts = ["2025-01-01T00:18:38", "2025-01-01T00:18:38.5", "2025-01-01", "NaT", "garbage", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert one(frame.select(parse_time(F.col("t")))) == [
        dt.datetime(2025, 1, 1, 0, 18, 38),
        dt.datetime(2025, 1, 1, 0, 18, 38, 500000),
        dt.datetime(2025, 1, 1),
        None,
        None,
        None,
        None,
    ]


def test_iso_text_shows_microseconds_only_where_present(spark):
    times = [dt.datetime(2025, 1, 1, 0, 18, 38), dt.datetime(2025, 1, 1, 0, 18, 38, 179001), None]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert one(frame.select(iso_text(F.col("t")))) == [
        "2025-01-01T00:18:38",
        "2025-01-01T00:18:38.179001",
        None,
    ]


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        ("2025-01-01T00:00:00.1", "2025-01-01T00:00:01.9", 1 / 60),
        ("2025-03-09T01:50:00", "2025-03-09T03:10:00", 80.0),
        ("2025-01-01T00:00:00", "2025-01-01T00:00:00", 0.0),
        ("2025-01-01T00:01:00", "2025-01-01T00:00:00", -1.0),
    ],
)
def test_duration_counts_whole_seconds(spark, start, end, minutes):
    frame = spark.createDataFrame([(start, end)], "a string, b string")
    duration = duration_minutes(parse_time(F.col("a")), parse_time(F.col("b")))
    assert one(frame.select(duration)) == [pytest.approx(minutes)]


def test_whole_number_cuts_and_never_fails(spark, ansi):
    values = [1.9, -1.9, float("nan"), 1e300, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert one(frame.select(whole_number(F.col("v"))))[:3] == [1, -1, None]
    assert one(frame.select(whole_number(F.col("v"))))[3:] == [None, None]


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame([(float("nan"),), (0.0,), (None,)], "v double")
    assert one(frame.select(nan_to_null(F.col("v")))) == [None, 0.0, None]


def test_speed(spark, ansi):
    cases = [
        (60.0, 30.0, 30.0),
        (30.0, 30.0, 60.0),
        (0.0, 1.0, None),
        (-1.0, 1.0, None),
        (1.0, 0.0, None),
        (1.0, -1.0, None),
        (None, 1.0, None),
        (1.0, None, None),
    ]
    frame = spark.createDataFrame(cases, "minutes double, distance double, speed double")
    minutes, distance = F.col("minutes"), F.col("distance")
    rows = frame.select(
        "speed",
        trip_speed(minutes, distance).alias("got"),
        speed_is_undefined(minutes, distance).alias("undefined"),
    ).collect()
    assert [r.got for r in rows] == [c[2] for c in cases]
    assert [r.undefined for r in rows] == [c[2] is None for c in cases]


def test_event_key_is_the_vendor_or_empty(spark):
    frame = spark.createDataFrame([(2,), (None,)], "VendorID int")
    assert one(frame.select(event_key())) == ["2", ""]
    places = one(frame.select(event_partition(event_key(), 3)))
    assert all(0 <= place < 3 for place in places)


FIELDS = ["VendorID", "tpep_pickup_datetime", "passenger_count", "PULocationID", "Airport_fee"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"VendorID":1.0,"passenger_count":"2","PULocationID":5}', (None, None, None, 5, None)),
        ('{"VendorID":1,"airport_fee":1.5,"extra_unknown":9}', (1, None, None, None, None)),
        ('{"VendorID":99999999999,"passenger_count":1}', (None, None, 1.0, None, None)),
        ('{"VendorID":1,"tpep_pickup_datetime":123,"VendorID":2}', (2, "123", None, None, None)),
        ("not json", (None,) * 5),
        ("null", (None,) * 5),
        ('[{"VendorID":1},{"VendorID":2}]', (None,) * 5),
        ('{"VendorID":1,"passenger', (None,) * 5),
        ("", (None,) * 5),
        (None, (None,) * 5),
    ],
)
def test_parse_event(spark, text, expected):
    value = None if text is None else bytearray(text.encode())
    frame = spark.createDataFrame([(value,)], "value binary")
    row = frame.select(parse_event(F.col("value")).alias("d")).select("d.*").select(*FIELDS).first()
    assert tuple(row) == expected


def test_parse_event_of_named_fields(spark):
    texts = [
        '{"VendorID": 1, "fare_amount": 2.5, "PULocationID": 3, "tip_amount": 1}',
        '{"VendorID": "x", "fare_amount": "1.5", "PULocationID": 4, "tip_amount": "no"}',
        '{"fare_amount": NaN, "more": {"VendorID": 9}, "VendorID": 2, "tip_amount": {}}',
        '{"VendorID": 1, "fare_amount": 2.5, "tip_amount": ', "[1]", "x", "", "{}", None,
    ]
    names = ("VendorID", "PULocationID", "fare_amount")
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    few, whole = (rows.select(parse_event(F.col("value"), *of).alias("d")) for of in (names, ()))
    assert few.schema["d"].dataType.names == list(names)
    got, want = ([tuple(r) for r in d.select(*(f"d.{n}" for n in names)).collect()] for d in (few, whole))
    assert str(got) == str(want) and got[0] == (1, 3, 2.5) and got[1] == (None, 4, None)


def test_parse_event_reads_a_bare_nan(spark):
    frame = spark.createDataFrame([(bytearray(b'{"VendorID":1,"passenger_count":NaN}'),)], "value binary")
    row = frame.select(parse_event(F.col("value")).alias("d")).select("d.*").first()
    assert row.VendorID == 1 and math.isnan(row.passenger_count)


def test_ddl_comes_from_the_schema(spark):
    ddl = ddl_columns(TRIP_WIRE)
    assert ddl.startswith("`VendorID` INT, `tpep_pickup_datetime` STRING")
    assert spark.createDataFrame([], ddl).schema == TRIP_WIRE
