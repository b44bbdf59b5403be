"""A zone join that one id cannot hold up, for lookups of any size."""

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import enrich

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def unbroadcast(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name in SETTINGS:
        spark.conf.unset(name)


def skewed(spark):
    """Nine tenths of the pickups, and of the drop-offs, are at one place; some have none."""
    n = F.col("id")
    return spark.range(0, 20_000, 1, 4).select(
        n,
        F.when(n % 10 > 0, 7).when(n % 100 == 0, None).otherwise(n % 500).cast("int").alias("PULocationID"),
        F.when(n % 10 != 5, 3).otherwise(n % 300).cast("int").alias("DOLocationID"),
    )


def lookup(spark):
    rows = spark.range(0, 450).select(F.col("id").cast("int").alias("LocationID"))
    named = rows.withColumn("Zone", F.concat(F.lit("z"), "LocationID"))
    return named.unionAll(named.where("LocationID = 7").withColumn("Zone", F.lit("zz")))


def test_names_are_those_of_a_plain_join(unbroadcast):
    done = enrich.with_zones(skewed(unbroadcast), lookup(unbroadcast)).collect()
    assert len(done) == 20_000
    for r in done:
        for zone_id, name in ((r.PULocationID, r.pickup_zone), (r.DOLocationID, r.dropoff_zone)):
            assert name == (f"z{zone_id}" if zone_id is not None and zone_id < 450 else None)


@pytest.mark.parametrize("role", ["PULocationID", "DOLocationID"])
def test_a_hot_id_is_dealt_into_several_parts(unbroadcast, role):
    trips = skewed(unbroadcast)
    hot = enrich.hot_ids(trips, role, 8)
    assert hot == {{"PULocationID": 7, "DOLocationID": 3}[role]: 8}
    done = enrich.with_zone_salted(trips, lookup(unbroadcast), role, "zone", hot, 8)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Python" not in plan
    spread = done.groupBy(F.spark_partition_id().alias("p")).agg(F.count("zone").alias("n"))
    assert max(r.n for r in spread.collect()) < 20_000 * 0.4


def test_a_small_lookup_is_broadcast_and_nothing_is_counted(spark):
    done = enrich.with_zones(skewed(spark), lookup(spark))
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "_salt" not in plan


def test_no_trips_and_no_hot_ids(unbroadcast):
    none = skewed(unbroadcast).limit(0)
    assert enrich.hot_ids(none, "PULocationID", 8) == {}
    assert enrich.with_zones(none, lookup(unbroadcast)).count() == 0
    even = unbroadcast.range(200).select(F.col("id").cast("int").alias("PULocationID"), F.lit(1).alias("DOLocationID"))
    assert enrich.hot_ids(even, "PULocationID", 8) == {}
    assert enrich.with_zones(even, lookup(unbroadcast)).where("pickup_zone is null").count() == 0
