"""Session settings."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The variables and, below, the settings that the connectors read.
CREDENTIALS = ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY")

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024

# The driver keeps a size for every pair of scan task and shuffle partition, and each pair
# is one piece to fetch, so neither number may grow without end. Beyond these the pieces
# get larger instead, and Spark sorts them by spilling.
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_SCAN_TASKS = 100_000

# Spark's default for spark.sql.files.maxPartitionBytes.
DEFAULT_SCAN_SPLIT_BYTES = 128 * 1024 * 1024

# Spark's default for spark.sql.files.openCostInBytes.
SMALLEST_SPLIT_BYTES = 4 * 1024 * 1024

# JSON text takes half of what it takes with Spark's default, snappy, and no more time.
CODEC = "zstd"

# Parquet is compressed and columnar; rows on their way through a shuffle take more.
SHUFFLE_GROWTH = 3


def object_store_settings(
    catalog: str,
    catalog_uri: str,
    warehouse: str,
    endpoint: str,
    region: str = "us-east-1",
    env: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Spark settings of an Iceberg REST catalog on an S3-like store.

    Credentials come from the environment and are checked before Spark starts.
    """
    env = os.environ if env is None else env
    missing = [name for name in CREDENTIALS if not env.get(name)]
    if missing:
        raise RuntimeError(f"the object store needs {' and '.join(missing)} to be set")
    access, secret = (env[name] for name in CREDENTIALS)
    prefix = f"spark.sql.catalog.{catalog}"
    return {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        f"{prefix}.uri": catalog_uri,
        f"{prefix}.warehouse": warehouse,
        f"{prefix}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
        f"{prefix}.s3.endpoint": endpoint,
        f"{prefix}.s3.path-style-access": "true",
        f"{prefix}.s3.access-key-id": access,
        f"{prefix}.s3.secret-access-key": secret,
        f"{prefix}.s3.region": region,
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access,
        "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def build_session(
    app_name: str = "tripstrata", settings: Mapping[str, str] | None = None
) -> SparkSession:
    """Get or start a session. The master is the launcher's choice, ``local[*]`` without one."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in (settings or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return use_utc(spark)


def use_utc(spark: SparkSession) -> SparkSession:
    """Durations over a clock change depend on the session time zone, so it is fixed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def job_session(spark: SparkSession) -> SparkSession:
    """A session of a job's own, in UTC, with the caller's settings as they are now.

    It shares the context and the catalog. Settings, views and streams of the one do not show
    in the other, so that a job leaves its caller's session as it was. Parquet is written with
    ``CODEC`` where the caller names none.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.compression.codec", CODEC)
    for name, value in spark.conf.getAll.items():
        if own.conf.get(name, None) != value and own.conf.isModifiable(name):
            own.conf.set(name, value)
    return use_utc(own)


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a join's side; negative where it never does."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def shuffle_partitions_for(input_bytes: int) -> int:
    """Shuffle partitions that hold about ``TARGET_SHUFFLE_BYTES`` each."""
    wanted = math.ceil(input_bytes * SHUFFLE_GROWTH / TARGET_SHUFFLE_BYTES)
    return max(1, min(wanted, MAX_SHUFFLE_PARTITIONS))


def scan_bytes(scan: DataFrame) -> int:
    """Size of a plain table scan as Spark's planner sees it: the size of its files."""
    return int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small_scan(spark: SparkSession, scan: DataFrame, key: str) -> DataFrame:
    """Spread a scan over all cores where it is too small to be split that far.

    Spark makes no split below ``SMALLEST_SPLIT_BYTES``, so a small file is read, and all
    that follows is computed, by a few tasks. A larger scan is left as it is.
    """
    cores = spark.sparkContext.defaultParallelism
    if scan_bytes(scan) < cores * SMALLEST_SPLIT_BYTES:
        return scan.repartition(cores, key)
    return scan


def scan_split_bytes_for(input_bytes: int) -> int:
    """Size of a scan task's input that keeps their number below ``MAX_SCAN_TASKS``."""
    return max(DEFAULT_SCAN_SPLIT_BYTES, math.ceil(input_bytes / MAX_SCAN_TASKS))


def size_for(spark: SparkSession, scan: DataFrame) -> int:
    """Fit the session's scans and shuffles to the size of ``scan``.

    Returns the number of partitions shuffles start with. Adaptive execution joins small
    ones afterwards but cannot add any, and the default of 200 would put 100 TB into
    pieces no executor can hold. The number is only ever raised.
    """
    input_bytes = scan_bytes(scan)
    split = scan_split_bytes_for(input_bytes)
    if split > DEFAULT_SCAN_SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffle_partitions_for(input_bytes)
    if wanted > current:
        spark.conf.set(name, str(wanted))
    return max(wanted, current)
