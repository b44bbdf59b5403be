"""Operators and layer plans on hand-made rows."""

import itertools
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.trip_rows import bronze, zones
from tripstrata.operators.aggregate import counted, row_counts, speed_stats, zone_speed
from tripstrata.operators.cleaning import valid_times
from tripstrata.operators.dedup import one_per_key
from tripstrata.operators.enrich import with_zones
from tripstrata.operators.guards import MissingInput, require_readable, require_rows
from tripstrata.operators.ranking import SAMPLE_COLUMNS, top_zones, trip_sample
from tripstrata.operators.replay import in_file_order, replay, replay_progress
from tripstrata.plans.layers import build_gold, build_silver
from tripstrata.schemas import SILVER

ZONES = [(1, "North"), (2, "South")]


def silver_of(spark, *rows, lookup=ZONES):
    return build_silver(bronze(spark, *rows), zones(spark, *lookup))


def test_valid_times(spark):
    rows = bronze(
        spark,
        {"VendorID": 1},
        {"VendorID": 2, "tpep_dropoff_datetime": "2025-01-01T00:00:00"},
        {"VendorID": 3, "tpep_dropoff_datetime": "2024-12-31T23:59:59"},
        {"VendorID": 4, "tpep_pickup_datetime": None},
        {"VendorID": 5, "tpep_dropoff_datetime": "NaT"},
    )
    assert sorted(r.VendorID for r in valid_times(rows).collect()) == [1, 2]


def test_dedup_treats_nulls_nans_and_zeros_as_equal(spark):
    rows = [(None, 1.0), (None, 1.0), (1, float("nan")), (1, float("nan")), (2, 0.0), (2, -0.0)]
    frame = spark.createDataFrame(rows, "a int, b double").withColumn("c", F.lit(1))
    assert one_per_key(frame, ["a", "b"], ["c"]).count() == 3


def test_dedup_picks_one_whole_row_whatever_the_order(spark):
    rows = [(1, 2, 5.0), (1, 1, 9.0), (1, None, 7.0), (1, None, 8.0)]
    for order in itertools.permutations(rows):
        frame = spark.createDataFrame(order, "k int, p int, t double").repartition(3)
        assert [tuple(r) for r in one_per_key(frame, ["k"], ["p", "t"]).collect()] == [(1, None, 7.0)]


_cells = st.one_of(st.none(), st.integers(0, 2))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_cells, _cells, _cells), min_size=1, max_size=30))
def test_dedup_agrees_with_brute_force(spark, rows):
    expected = {}
    for a, b, c in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0)):
        expected.setdefault((a, b), c)
    frame = spark.createDataFrame(rows, "a int, b int, c int")
    got = {(r.a, r.b): r.c for r in one_per_key(frame, ["a", "b"], ["c"]).collect()}
    assert got == expected


def test_silver_schema_and_values(spark):
    silver = silver_of(spark, {"passenger_count": 1.9})
    assert silver.columns == SILVER.names
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]
    row = silver.first()
    assert (row.passenger_count, row.trip_duration_minutes, row.trip_speed_kmh) == (1, 30.0, 20.0)
    assert (row.pickup_zone, row.dropoff_zone) == ("North", "South")


def test_silver_compares_time_text_not_instants(spark):
    assert silver_of(spark, {}, {}, {"tpep_pickup_datetime": "2025-01-01 00:00:00"}).count() == 2


def test_silver_keeps_zero_length_trips_without_a_speed(spark):
    row = silver_of(spark, {"tpep_dropoff_datetime": "2025-01-01T00:00:00"}).first()
    assert row.trip_duration_minutes == 0.0 and row.trip_speed_kmh is None


def test_nan_does_not_reach_the_aggregates(spark):
    nan = float("nan")
    silver = silver_of(spark, {}, {"trip_distance": nan, "passenger_count": nan, "tip_amount": nan})
    stats = speed_stats(silver).first()
    assert (stats.max_trip_speed_kmh, stats.null_speed_rows, stats.total_rows) == (20.0, 1, 2)
    assert not any(isinstance(v, float) and math.isnan(v) for r in silver.collect() for v in r)
    assert build_gold(silver).first().max_speed_kmh == 20.0


def test_unknown_and_missing_zones_keep_the_trip(spark):
    silver = silver_of(spark, {"PULocationID": 99}, {"PULocationID": None}, {})
    assert sorted(str(r.pickup_zone) for r in silver.collect()) == ["None", "None", "North"]


def test_a_repeated_zone_id_does_not_multiply_trips(spark):
    lookup = [(1, "North"), (1, "Again"), (None, "Nowhere"), (2, "South")]
    silver = silver_of(spark, {}, {"PULocationID": None}, lookup=lookup)
    assert sorted(str(r.pickup_zone) for r in silver.collect()) == ["Again", "None"]


def test_zones_join_alike_when_the_lookup_is_too_large_to_broadcast(spark):
    trips = bronze(spark, *({"PULocationID": n % 4, "fare_amount": float(n)} for n in range(40)))
    small = sorted(map(str, with_zones(trips, zones(spark, *ZONES)).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = with_zones(trips, zones(spark, *ZONES))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert sorted(map(str, joined.collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_gold_groups_by_name_and_skips_missing(spark):
    silver = spark.createDataFrame(
        [("A", 10.0), ("A", 30.0), ("A", None), ("B", 5.0), ("C", None), (None, 7.0)],
        "pickup_zone string, trip_speed_kmh double",
    )
    assert sorted(map(tuple, zone_speed(silver).collect())) == [("A", 20.0, 30.0), ("B", 5.0, 5.0)]


def test_two_ids_of_one_name_make_one_gold_row(spark):
    silver = silver_of(spark, {}, {"PULocationID": 3}, lookup=[(1, "N"), (3, "N")])
    assert build_gold(silver).count() == 1


def test_stats_over_nothing(spark):
    silver = silver_of(spark, {"tpep_pickup_datetime": None})
    assert tuple(speed_stats(silver).first()) == (None, None, None, 0)


def test_row_counts(spark):
    counts = row_counts({"a": counted(spark.range(3)), "b": counted(spark.range(0))})
    assert {r.layer: r.row_count for r in counts.collect()} == {"a": 3, "b": 0}


def test_top_zones_breaks_ties_by_name_and_puts_nulls_last(spark):
    rows = [("D", 1.0, None), ("C", 1.0, 5.0), ("A", 1.0, 5.0), ("B", 1.0, 9.0)]
    gold = spark.createDataFrame(rows, "pickup_zone string, avg_speed_kmh double, max_speed_kmh double")
    assert [r.pickup_zone for r in top_zones(gold, 4).collect()] == ["B", "A", "C", "D"]
    assert top_zones(gold, 2).count() == 2


def test_trip_sample(spark):
    rows = bronze(spark, *({"VendorID": n} for n in range(20)))
    sample = trip_sample(rows, 3)
    assert sample.columns == SAMPLE_COLUMNS
    assert [r.VendorID for r in sample.collect()] == [0, 1, 2]
    assert trip_sample(rows, 3, repeatable=False).count() == 3


def test_guards(spark, tmp_path):
    with pytest.raises(MissingInput, match="bronze cannot be read"):
        require_readable(lambda: spark.read.parquet(str(tmp_path / "none")), "bronze", "run it")
    with pytest.raises(MissingInput, match="bronze is empty"):
        require_rows(bronze(spark), "bronze", "fill it")
    assert require_rows(spark.range(1), "x", "y").count() == 1


@pytest.fixture
def trip_files(spark, tmp_path):
    """Seven files of different lengths, 100 trips in all, in file and row order."""
    lengths, start = [1, 30, 5, 40, 4, 19, 1], 0
    for number, length in enumerate(lengths):
        rows = [{"VendorID": n, "fare_amount": float(n)} for n in range(start, start + length)]
        single = bronze(spark, *rows).coalesce(1).sortWithinPartitions("VendorID")
        single.write.parquet(f"{tmp_path}/trips/file={number}")
        start += length
    return f"{tmp_path}/trips"


def test_file_order_is_exact_over_many_files(spark, trip_files):
    rows = in_file_order(spark, trip_files).collect()
    assert sorted((r.VendorID, r.ordinal, r.total) for r in rows) == [
        (n, n + 1, 100) for n in range(100)
    ]


def test_file_order_without_a_broadcast(spark, trip_files):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        rows = in_file_order(spark, trip_files).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted((r.VendorID, r.ordinal) for r in rows) == [(n, n + 1) for n in range(100)]


def test_file_order_goes_by_number(spark, tmp_path):
    path = f"{tmp_path}/many"
    spark.range(0, 1105, 1, 1).write.option("maxRecordsPerFile", 1).parquet(path)
    rows = in_file_order(spark, path).collect()
    assert all(r.ordinal == r.id + 1 for r in rows) and len(rows) == 1105


def test_file_order_does_not_depend_on_splits(spark, tmp_path):
    path = f"{tmp_path}/split"
    spark.range(0, 20000, 1, 1).write.option("parquet.block.size", 4096).parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        numbered = in_file_order(spark, path)
        assert numbered.filter(F.col("ordinal") != F.col("id") + 1).count() == 0
        assert numbered.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_replay_schedule(spark, trip_files):
    events = replay(spark, trip_files, rate=5.0, passes=2).collect()
    assert len(events) == 200
    for e in events:
        assert e.ordinal == (e["pass"] - 1) * 100 + e.VendorID + 1
        assert e.release_second == (e.ordinal - 1) // 5
    with pytest.raises(ValueError):
        replay(spark, trip_files, rate=0)


def test_replay_progress(spark, trip_files):
    events = replay(spark, trip_files, rate=5.0, passes=1)
    rows = replay_progress(events, rate=5.0, every=40).orderBy("sent").collect()
    assert [(r.sent, r.elapsed_seconds) for r in rows] == [
        (1, 0.0),
        (40, 7.8),
        (80, 15.8),
        (100, 19.8),
    ]
    assert [r.report for r in rows] == [0, 1, 2, 3]
    assert rows[1].events_per_second == pytest.approx(40 / 7.8)
    first = replay_progress(events.filter("ordinal = 1")).first()
    assert first.elapsed_seconds == 0.0 and first.events_per_second is None


def test_hot_key_gives_the_same_layers(spark):
    """A third of all trips are copies of one trip, a third leave from one zone."""
    random.seed(3)
    hot = [{"fare_amount": 1.0, "PULocationID": 1}] * 400
    zone = [{"fare_amount": 100.0 + n, "PULocationID": 1} for n in range(400)]
    rest = [
        {"fare_amount": 1000.0 + n, "PULocationID": random.randrange(5), "VendorID": n % 3}
        for n in range(400)
    ]
    rows = hot + zone + rest
    random.shuffle(rows)
    trips = bronze(spark, *rows).repartition(16)
    silver = build_silver(trips, zones(spark, *ZONES))
    assert silver.count() == 801
    gold = {r.pickup_zone: r.max_speed_kmh for r in build_gold(silver).collect()}
    assert gold == {"North": 20.0, "South": 20.0}


def test_dedup_is_idempotent(spark):
    rows = bronze(spark, {}, {}, {"payment_type": 3}, {"fare_amount": 7.0})
    once = one_per_key(rows, ["fare_amount"], ["payment_type"])
    twice = one_per_key(once, ["fare_amount"], ["payment_type"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
