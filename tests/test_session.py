"""Settings, shuffle sizes and work folders."""

import pytest
from pyspark.sql import functions as F

from tripstrata.fixtures import trips
from tripstrata.sources import workspace
from tripstrata.sources.session import (
    MAX_SHUFFLE_PARTITIONS,
    build_session,
    job_session,
    object_store_settings,
    scan_split_bytes_for,
    shuffle_partitions_for,
    size_for,
    spread_small_scan,
)
from tripstrata.sources.topic import write_topic

STORE = ("lake", "http://catalog", "s3://bucket/", "http://store")
SPLIT = "spark.sql.files.maxPartitionBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_credentials_are_checked_before_spark_starts():
    for env in ({}, {"AWS_ACCESS_KEY_ID": "a"}, {"AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": ""}):
        with pytest.raises(RuntimeError, match="AWS_SECRET_ACCESS_KEY"):
            object_store_settings(*STORE, env=env)


def test_store_settings():
    env = {"AWS_ACCESS_KEY_ID": "a", "AWS_SECRET_ACCESS_KEY": "b"}
    settings = object_store_settings(*STORE, env=env)
    assert settings["spark.sql.catalog.lake.uri"] == "http://catalog"
    assert settings["spark.sql.catalog.lake.s3.secret-access-key"] == "b"


def test_session_is_shared_and_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    session = build_session(settings={"spark.sql.shuffle.partitions": "8"})
    assert session.sparkContext is spark.sparkContext
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions_for(0) == 1
    assert shuffle_partitions_for(10 * 1024**3) == 240
    assert shuffle_partitions_for(100 * 1024**4) == MAX_SHUFFLE_PARTITIONS


def test_scan_tasks_are_bounded():
    assert scan_split_bytes_for(10 * 1024**3) == 128 * 1024**2
    assert scan_split_bytes_for(100 * 10**12) == 10**9


def test_shuffles_are_only_ever_enlarged(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    before = spark.conf.get(SPLIT)
    assert size_for(spark, scan) == 8
    assert spark.conf.get(INITIAL, None) is None
    assert spark.conf.get(SPLIT) == before
    monkeypatch.setattr("tripstrata.sources.session.scan_bytes", lambda frame: 10 * 1024**3)
    try:
        assert size_for(spark, scan) == 240
        monkeypatch.setattr("tripstrata.sources.session.scan_bytes", lambda frame: 10**14)
        assert size_for(spark, scan) == MAX_SHUFFLE_PARTITIONS
        assert spark.conf.get(SPLIT) == "1000000000"
        monkeypatch.undo()
        assert size_for(spark, scan) == MAX_SHUFFLE_PARTITIONS
    finally:
        spark.conf.unset(INITIAL)
        spark.conf.unset(SPLIT)


def test_only_a_small_scan_is_spread(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    scan = spark.read.parquet(f"{tmp_path}/t")
    assert "RepartitionByExpression" in spread_small_scan(spark, scan, "id")._jdf.logicalPlan().toString()
    monkeypatch.setattr("tripstrata.sources.session.scan_bytes", lambda frame: 10 * 1024**3)
    assert spread_small_scan(spark, scan, "id") is scan


class Session:
    """Stands for a session with given settings."""

    def __init__(self, named, master):
        self.named = named
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda s: None})()
        self.conf = type("Conf", (), {"get": lambda s, name, default: named})()


def test_work_folders(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace.new_folder(spark, "x"), workspace.new_folder(spark, "x")
    assert first != second and first.startswith(f"{shared}/x-")
    assert workspace.shared_folder(Session("hdfs://shared/", "yarn")) == "hdfs://shared"
    assert "tripstrata-" in workspace.shared_folder(Session(None, "local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session(None, "yarn"))


def test_a_job_session_leaves_the_caller_as_it_was(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.range(3).createOrReplaceTempView("kept")
    try:
        own = job_session(spark)
        assert own.conf.get("spark.sql.shuffle.partitions") == "5"
        assert own.conf.get("spark.sql.session.timeZone") == "UTC"
        before = dict(spark.conf.getAll)
        own.conf.set("spark.sql.shuffle.partitions", "77")
        own.range(9).createOrReplaceTempView("kept")
        own.range(9).createOrReplaceTempView("other")
        assert dict(spark.conf.getAll) == before
        assert spark.table("kept").count() == 3 and not spark.catalog.tableExists("other")
        assert own.sparkContext.applicationId == spark.sparkContext.applicationId
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.catalog.dropTempView("kept")


def test_jobs_write_smaller_parquet(spark, tmp_path):
    """Unless the caller names a codec, what jobs and topics write takes zstd."""
    name = "spark.sql.parquet.compression.codec"
    assert job_session(spark).conf.get(name) == "zstd"
    text = F.to_json(F.struct(F.col("id"), (F.col("id") * 7919 % 1000).alias("fare"), F.lit("N").alias("flag")))
    rows = spark.range(0, 50_000, 1, 1).select(text.cast("binary").alias("value"))
    write_topic(rows, f"{tmp_path}/zstd")
    write_topic(rows, f"{tmp_path}/snappy", options={"compression": "snappy"})
    assert all(".zstd." in f for f in spark.read.parquet(f"{tmp_path}/zstd").inputFiles())
    sizes = [
        spark.read.parquet(f"{tmp_path}/{c}").select("_metadata.file_size").first()[0] for c in ("zstd", "snappy")
    ]
    assert sizes[0] < sizes[1]
    spark.conf.set(name, "gzip")
    try:
        assert job_session(spark).conf.get(name) == "gzip"
    finally:
        spark.conf.unset(name)
    assert spark.conf.get(name, None) is None


def test_copies_of_trips_read_their_orders_only(spark, tmp_path):
    """The rows that are no copies do not get to the joins."""
    tables = {
        "lineitem": "id l_orderkey, 1 l_linenumber, id l_partkey, 1 l_suppkey, 4d l_quantity, 2d l_extendedprice, 1d l_discount",
        "orders": "id o_orderkey, 1 o_custkey, timestamp'2025-01-01' o_orderdate",
        "customer": "1 c_custkey, 1 c_nationkey",
        "supplier": "1 s_suppkey, 2 s_nationkey",
    }
    for name, columns in tables.items():
        rows = spark.range(30 if "id" in columns.split() else 1)
        rows.selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    copies = trips(spark, str(tmp_path), "copies")
    plan = copies._jdf.queryExecution().optimizedPlan().toString()
    assert "% 10" in plan and "% 10" not in plan.split("Join")[0]
    assert [trips(spark, str(tmp_path), part).count() for part in ("base", "copies", "all")] == [30, 3, 33]
