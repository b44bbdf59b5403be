
from __future__ import annotations

import sys
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripstrata.fixtures import (  # noqa: E402
    stored,
    stored_trips,
    trip_file_columns,
    write_in_order,
    zones,
)
from tripstrata.functions.events import parse_event  # noqa: E402
from tripstrata.functions.speed import speed_is_undefined  # noqa: E402
from tripstrata.operators.aggregate import column_fill, row_counts, speed_stats  # noqa: E402
from tripstrata.operators.cleaning import (  # noqa: E402
    needed_fields,
    valid_times,
    with_duration,
    with_speed,
)
from tripstrata.operators.dedup import one_per_key  # noqa: E402
from tripstrata.operators.enrich import with_zones, zone_names  # noqa: E402
from tripstrata.operators.ranking import latest_commits, top_zones, trip_sample  # noqa: E402
from tripstrata.operators.replay import replay, replay_progress  # noqa: E402
from tripstrata.operators.sequence import in_key_order  # noqa: E402
from tripstrata.plans import jobs  # noqa: E402
from tripstrata.plans.layers import Layers, build_gold, build_silver  # noqa: E402
from tripstrata.schemas import SILVER, TRIP_KEY, TRIP_REST, TRIP_WIRE  # noqa: E402
from tripstrata.sources.lookups import read_trips, read_zones, to_wire  # noqa: E402
from tripstrata.sources.session import job_session, size_for  # noqa: E402
from tripstrata.sources.tables import Conflict  # noqa: E402
from tripstrata.sources.topic import read_topic, stream_topic, to_events, write_topic  # noqa: E402
from tripstrata.sources.workspace import new_folder  # noqa: E402
from tripstrata.streaming.replay import read_reports  # noqa: E402
from tripstrata.streaming.bronze import (  # noqa: E402
    create_bronze_table,
    ingest_available,
    parse_events,
    read_bronze,
    start_bronze,
)

try:
    import corpus_pipeline
    from tripstrata.llm import queries as corpus_queries
except ModuleNotFoundError as error:
    # Both are optional and go together; anything else that is missing is a fault.
    if not (error.name or "").startswith(("corpus_pipeline", "tripstrata.llm")):
        raise
    corpus_pipeline = corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
TOPIC = "trips"
REPLAY_RATE = 5.0
REPLAY_PASSES = 3
HISTORY_COMMITS = 7
#: Events of one window of the paced replay.
PACED_SHARE = 40_000

Query = Callable[[SparkSession, str], DataFrame]


def _prepared_session(spark: SparkSession, sf_dir: str) -> SparkSession:
    """A session of the query's own, fit to the size of the tables."""
    own = job_session(spark)
    size_for(own, own.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return own


def trips(spark: SparkSession, sf_dir: str, part: str = "all") -> DataFrame:
    """All trips of the given tables, read back from the table they are kept in."""
    return read_bronze(spark, stored_trips(spark, sf_dir, part))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(trips(spark, sf_dir), zones(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(_silver(spark, sf_dir))


# Scans


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "zones")
    zones(spark, sf_dir).write.parquet(path)
    return zone_names(read_zones(spark, path))


def trip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "trip-file")
    trip_file_columns(trips(spark, sf_dir)).write.parquet(path)
    return read_trips(spark, path)


def trip_scan_other_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose files differ in the case of names, in types and in missing columns."""
    path, wire = new_folder(spark, "mixed-trips"), trips(spark, sf_dir)
    rows, kind = trip_file_columns(wire), F.coalesce("VendorID", F.lit(0)) % 3
    lower = rows.where(kind == 1).select(*(F.col(c).alias(c.lower()) for c in rows.columns))
    lower = lower.withColumns({c: F.col(c).cast("long") for c in ("vendorid", "pulocationid", "payment_type")})
    texts = wire.where(kind == 2).select(
        *(F.col(c).cast("string").alias(c.upper()) for c in TRIP_KEY + TRIP_REST)
    )
    for part in (rows.where(kind == 0), lower, texts):
        part.write.mode("append").parquet(path)
    return read_trips(spark, path)


# Events


def trip_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and JSON fields as they stand in the published text."""
    events = to_events(trips(spark, sf_dir), TOPIC).select(
        F.col("key").cast("string").alias("event_key"), F.col("value").cast("string").alias("text")
    )
    fields = events.select(
        "event_key",
        F.size(F.json_object_keys("text")).alias("n_fields"),
        F.json_tuple("text", *TRIP_WIRE.names).alias(*TRIP_WIRE.names),
    )
    return fields.select(
        "event_key",
        "n_fields",
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in TRIP_WIRE),
    )


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(to_events(trips(spark, sf_dir), TOPIC))


def vendor_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a published trip file, put in the order of their vendors by their headers."""
    topic = new_folder(spark, "ordered")
    jobs.publish_trips(spark, _trip_file(spark, sf_dir), topic, TOPIC)
    event = parse_event(F.col("value"))
    fields = (event[name].alias(name) for name in ("tpep_pickup_datetime", "fare_amount"))
    return in_key_order(read_topic(spark, topic), *fields)


# Streams


def _publish(spark: SparkSession, sf_dir: str, folder: str, part: str = "all") -> None:
    write_topic(to_events(trips(spark, sf_dir, part), TOPIC), folder)


def _events(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """Stream over the topic that holds all trips."""
    topic = stored(spark, sf_dir, "topic", lambda path: _publish(spark, sf_dir, path))
    return stream_topic(spark, topic, TOPIC, options=options)


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(new_folder(spark, "stream"))
    events = _events(spark, sf_dir, maxFilesPerTrigger="64")
    ingest_available(events, layers.checkpoint, path=layers.bronze)
    return read_bronze(spark, layers.bronze)


def bronze_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, restart without new events, publish more, restart: every event once."""
    root = new_folder(spark, "restart")
    layers, topic = Layers(root), f"{root}/topic"
    for part in ("base", None, "copies"):
        if part:
            _publish(spark, sf_dir, topic, part)
        events = stream_topic(spark, topic, TOPIC)
        ingest_available(events, layers.checkpoint, path=layers.bronze)
    return read_bronze(spark, layers.bronze)


def bronze_inflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-vendor counts over one committed batch of bronze while its stream was running."""
    layers = Layers(new_folder(spark, "inflight"))
    events = _events(spark, sf_dir)
    query = start_bronze(events, layers.checkpoint, path=layers.bronze, trigger="1 second")
    try:
        query.processAllAvailable()
        running, batch = layers.bronze_at(spark)
    finally:
        query.stop()
    counts = running.groupBy("VendorID").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("batch", F.lit(batch).cast("long"))


def bronze_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the declared bronze table, and how many ingested rows fill each."""
    root = new_folder(spark, "declared")
    database = root.rsplit("/", 1)[-1].replace("-", "_")
    try:
        create_bronze_table(spark, f"{database}.bronze", location=root)
        ingest_available(
            _events(spark, sf_dir), f"{root}/bronze_checkpoint", table=f"{database}.bronze"
        )
        return column_fill(spark.table(f"{database}.bronze"))
    finally:
        # The catalog forgets the table; its files stay for the report.
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


# Silver


def silver_valid_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_times(trips(spark, sf_dir)).select(
        "VendorID", "pickup_ts", "dropoff_ts", "PULocationID", "DOLocationID", "fare_amount"
    )


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_duration(valid_times(trips(spark, sf_dir))).select(
        "pickup_ts", "dropoff_ts", "trip_duration_minutes"
    )


def trip_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = with_duration(valid_times(trips(spark, sf_dir)))
    undefined = speed_is_undefined(F.col("trip_duration_minutes"), F.col("trip_distance"))
    return with_speed(timed).select(
        "trip_duration_minutes",
        "trip_distance",
        undefined.cast("int").alias("speed_undefined"),
        "trip_speed_kmh",
    )


def trips_with_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_zones(trips(spark, sf_dir), zones(spark, sf_dir))


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_key(needed_fields(trips(spark, sf_dir)), TRIP_KEY, TRIP_REST)


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def silver_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = Layers(new_folder(spark, "publish")).silver(spark)
    table.publish(_silver(spark, sf_dir))
    return table.read()


# Gold


def gold_zone_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir)


def _published_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Silver and gold refreshed from bronze by the job."""
    root = new_folder(spark, "layers")
    layers = Layers(root, bronze_path=stored_trips(spark, sf_dir))
    zones(spark, sf_dir).write.parquet(f"{root}/zones")
    jobs.refresh_silver_and_gold(spark, layers, f"{root}/zones")
    return layers


def gold_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _published_layers(spark, sf_dir)
    return layers.gold(spark).read()


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of all trips, read back from the table it is kept in."""
    path = stored(spark, sf_dir, "silver", _silver(spark, sf_dir).write.parquet)
    return spark.read.schema(SILVER).parquet(path)


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five latest of seven refreshes, of ever more vendors, latest first.

    The log is compacted on the way, and versions before the last three expire at the end.
    """
    table = Layers(new_folder(spark, "history")).silver(spark)
    silver = _stored_silver(spark, sf_dir)
    for n in range(1, HISTORY_COMMITS + 1):
        table.publish(silver.where(F.col("vendor_id") <= n))
        if n % 3 == 0:
            table.compact_log()
    table.expire(keep=3, grace_seconds=0)
    latest = latest_commits(table.history())
    place = F.row_number().over(Window.orderBy(F.desc("committed_at"), "snapshot_id"))
    of_commit = table.history().select("snapshot_id", "sequence", "n_rows")
    left = table.readable().select("snapshot_id", F.lit(1).alias("left"))
    return (
        latest.withColumn("place", place)
        .join(of_commit, "snapshot_id")
        .join(left, "snapshot_id", "left")
        .select("place", "sequence", "operation", "n_rows", F.coalesce("left", F.lit(0)).alias("readable"))
    )


def publish_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes at the same time, and one that is refused as it began from an older version."""
    table = Layers(new_folder(spark, "conflict")).silver(spark)
    silver = _stored_silver(spark, sf_dir)
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(table.publish, silver) for _ in range(2)]:
            done.result()
    refused = 0
    try:
        table.publish(silver.limit(0), expected=1)
    except Conflict:
        refused = 1
    latest = table.read().agg(F.count(F.lit(1)).alias("latest_rows"))
    log = table.history().select("sequence", "operation", "n_rows", F.lit(refused).alias("refused"))
    return log.join(F.broadcast(latest), F.col("n_rows") == F.col("latest_rows"))


# Statistics


def speed_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed_stats(_silver(spark, sf_dir))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _published_layers(spark, sf_dir)
    return jobs.statistics(spark, layers)["row_counts"]


def top_zones_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_zones(_gold(spark, sf_dir))


def bronze_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_sample(trips(spark, sf_dir), 10)


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT COUNT(*) AS row_count FROM bronze"
    return jobs.run_sql(spark, text, {"bronze": trips(spark, sf_dir)})


def adhoc_sql_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT * FROM silver
        ORDER BY fare_amount DESC, trip_distance DESC NULLS LAST, pickup_datetime, dropoff_datetime,
                 vendor_id, pu_location_id, do_location_id
        LIMIT 3
    """
    return jobs.run_sql(spark, text, {"silver": _silver(spark, sf_dir)})


# Replay


def _trip_file(spark: SparkSession, sf_dir: str) -> str:
    """The trips as a file in a known order."""
    rows = trips(spark, sf_dir)
    return stored(spark, sf_dir, "trip-file", lambda path: write_in_order(rows, path))


_REPLAY_COLUMNS = [
    "ordinal",
    "release_second",
    "VendorID",
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
]


def replay_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = to_wire(replay(spark, _trip_file(spark, sf_dir), REPLAY_RATE))
    return events.select(*_REPLAY_COLUMNS)


def replay_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = to_wire(replay(spark, _trip_file(spark, sf_dir), REPLAY_RATE, REPLAY_PASSES))
    return events.select("pass", *_REPLAY_COLUMNS)


def replay_progress_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = to_wire(replay(spark, _trip_file(spark, sf_dir), REPLAY_RATE))
    return replay_progress(events, REPLAY_RATE)


def _paced(spark: SparkSession, sf_dir: str, passes: int) -> DataFrame:
    """Events that the replay job sent, with the number of the window they arrived in."""
    root = new_folder(spark, "paced")
    # Windows go out as fast as they can; their size is what the rate and trigger give.
    job = jobs.start_paced_replay(
        spark,
        _trip_file(spark, sf_dir),
        f"{root}/staging",
        f"{root}/topic",
        rate=PACED_SHARE * 20.0,
        passes=passes,
        trigger_seconds=0.05,
    )
    job.run_to_end()
    sent = read_topic(spark, f"{root}/topic")
    # One row per window: windows have a time each, and arrive one after the other.
    times = sent.select("timestamp").distinct()
    rank = F.row_number().over(Window.orderBy("timestamp")).cast("long") - 1
    # They are so few that the events need not move to meet them.
    rows = sent.withColumn("event", parse_event(F.col("value"), *_REPLAY_COLUMNS[2:])).select(
        "timestamp",
        (F.col("offset") + 1).alias("ordinal"),
        *(F.col(f"event.{c}") for c in _REPLAY_COLUMNS[2:]),
    )
    return rows.join(F.broadcast(times.withColumn("batch", rank)), "timestamp").select(
        "ordinal", "batch", *_REPLAY_COLUMNS[2:]
    )


def replay_paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paced(spark, sf_dir, 1)


def replay_paced_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paced(spark, sf_dir, REPLAY_PASSES)


def replay_live_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replay told of itself while it ran, stopped on its way and started again.

    Spark remembers three windows only; the reports do not depend on it.
    """
    root, told = new_folder(spark, "live"), []
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(remembered, None)
    spark.conf.set(remembered, 3)
    try:
        for to_end in (False, True):
            job = jobs.start_paced_replay(
                spark,
                _trip_file(spark, sf_dir),
                f"{root}/staging",
                f"{root}/topic",
                rate=PACED_SHARE * 20.0,
                trigger_seconds=0.05,
                tell=lambda report: told.append((report["batch"], report["sent"])),
            )
            if to_end:
                job.run_to_end()
            else:
                while not told and job.query.isActive:
                    time.sleep(0.05)
                job.query.stop()
                job.stop_report()
    finally:
        spark.conf.unset(remembered) if before is None else spark.conf.set(remembered, before)
    # The log has the reports' fields; what was told of it are the windows' numbers and places.
    shown = spark.createDataFrame(told, "batch long, sent long").distinct()
    return shown.join(read_reports(spark, f"{root}/staging/reports", end=job.events), "sent").drop(
        "elapsed_seconds"
    )


_QUERIES: dict[str, Query] = {
    "zone_lookup": zone_lookup,
    "trip_scan": trip_scan,
    "trip_scan_other_case": trip_scan_other_case,
    "trip_events_json": trip_events_json,
    "bronze_parse": bronze_parse,
    "vendor_order": vendor_order,
    "bronze_stream": bronze_stream,
    "bronze_restart": bronze_restart,
    "bronze_inflight": bronze_inflight,
    "bronze_schema": bronze_schema,
    "bronze_sample": bronze_sample,
    "silver_valid_times": silver_valid_times,
    "trip_duration": trip_duration,
    "trip_speed": trip_speed,
    "trips_with_zones": trips_with_zones,
    "silver_dedup": silver_dedup,
    "silver_trips": silver_trips,
    "silver_publish": silver_publish,
    "gold_zone_speed": gold_zone_speed,
    "gold_partitioned": gold_partitioned,
    "snapshot_history": snapshot_history,
    "publish_conflict": publish_conflict,
    "speed_stats": speed_stats_query,
    "layer_counts": layer_counts,
    "top_zones": top_zones_query,
    "adhoc_sql": adhoc_sql,
    "adhoc_sql_sample": adhoc_sql_sample,
    "replay_schedule": replay_schedule,
    "replay_passes": replay_passes,
    "replay_progress": replay_progress_query,
    "replay_paced": replay_paced,
    "replay_paced_passes": replay_paced_passes,
    "replay_live_report": replay_live_report,
}


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(_prepared_session(spark, sf_dir), sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Trips through the topic's JSON to silver, and from there speed per zone."""
    spark = _prepared_session(spark, SMOKE_DIR)
    events = to_events(trips(spark, SMOKE_DIR), TOPIC)
    return build_gold(build_silver(parse_events(events), zones(spark, SMOKE_DIR)))


def queries() -> dict[str, Query]:
    found = {name: _prepared(query) for name, query in _QUERIES.items()}
    if corpus_queries:
        found |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


# SQL twins. They share no code with the queries; the fixture is written out again.

# The wire's fields, written out here so that a change in the library shows.
_FIELDS = [
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "string"),
    ("tpep_dropoff_datetime", "string"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("payment_type", "int"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("Airport_fee", "double"),
    ("cbd_congestion_fee", "double"),
]
# The fields that silver is made of.
_KEPT_BY_SILVER = {
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
}
_WIRE = ", ".join(f'"{name}"' for name, _ in _FIELDS)

_FIXTURES = f"""
zones AS (
    SELECT n_nationkey AS LocationID,
           CASE WHEN n_nationkey = 4 THEN 'NATION_3' ELSE n_name END AS Zone
    FROM nation WHERE n_nationkey < 22
),
lines AS (
    SELECT CAST(l_linenumber AS INT) AS "VendorID",
           CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN 'not-a-time'
                ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS tpep_pickup_datetime,
           strftime(o_orderdate + to_minutes(CAST(l_partkey % 60 - 5 AS BIGINT))
                    + to_seconds(CAST(l_suppkey % 60 AS BIGINT)),
                    '%Y-%m-%dT%H:%M:%S') AS tpep_dropoff_datetime,
           CASE WHEN l_partkey % 41 = 0 THEN NULL
                ELSE CAST(1 + l_suppkey % 6 AS DOUBLE) END AS passenger_count,
           CASE WHEN l_partkey % 83 = 0 THEN CAST(0 AS DOUBLE) WHEN l_partkey % 79 = 0 THEN NULL
                ELSE l_quantity / CAST(4 AS DOUBLE) END AS trip_distance,
           CAST(1 AS DOUBLE) AS "RatecodeID",
           'N' AS store_and_fwd_flag,
           c_nationkey AS "PULocationID",
           s_nationkey AS "DOLocationID",
           CAST(1 + l_linenumber % 4 AS INT) AS payment_type,
           l_extendedprice AS fare_amount,
           CAST(0 AS DOUBLE) AS extra,
           CAST(0.5 AS DOUBLE) AS mta_tax,
           l_discount AS tip_amount,
           CAST(0 AS DOUBLE) AS tolls_amount,
           CAST(1 AS DOUBLE) AS improvement_surcharge,
           l_extendedprice + l_discount AS total_amount,
           CAST(2.5 AS DOUBLE) AS congestion_surcharge,
           CAST(0 AS DOUBLE) AS "Airport_fee",
           CAST(0.75 AS DOUBLE) AS cbd_congestion_fee,
           l_orderkey
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
),
trips AS (
    SELECT {_WIRE} FROM lines
    UNION ALL
    SELECT {_WIRE} FROM lines WHERE l_orderkey % 10 = 0
)"""


def _silver_ctes(source: str, name: str) -> str:
    """Silver as a named subquery over ``source``."""
    return f"""
{name}_valid AS (
    SELECT *, date_diff('second', pts, dts) / CAST(60 AS DOUBLE) AS minutes
    FROM (SELECT *, try_cast(tpep_pickup_datetime AS TIMESTAMP) AS pts,
                 try_cast(tpep_dropoff_datetime AS TIMESTAMP) AS dts FROM {source})
    WHERE pts IS NOT NULL AND dts IS NOT NULL AND dts >= pts
),
{name}_numbered AS (
    SELECT *, row_number() OVER (
        PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
                     PULocationID, DOLocationID, trip_distance, fare_amount
        ORDER BY payment_type NULLS FIRST, trunc(passenger_count) NULLS FIRST,
                 tip_amount NULLS FIRST, total_amount NULLS FIRST) AS rn
    FROM {name}_valid
),
{name} AS (
    SELECT VendorID AS vendor_id, pts AS pickup_datetime, dts AS dropoff_datetime,
           CAST(trunc(passenger_count) AS INT) AS passenger_count, trip_distance,
           PULocationID AS pu_location_id, DOLocationID AS do_location_id, payment_type,
           fare_amount, tip_amount, total_amount,
           a.Zone AS pickup_zone, b.Zone AS dropoff_zone,
           minutes AS trip_duration_minutes,
           CASE WHEN trip_distance IS NULL OR minutes <= 0 OR trip_distance <= 0 THEN NULL
                ELSE trip_distance / (minutes / 60) END AS trip_speed_kmh
    FROM {name}_numbered
    LEFT JOIN zones a ON PULocationID = a.LocationID
    LEFT JOIN zones b ON DOLocationID = b.LocationID
    WHERE rn = 1
)"""


_SILVER = _silver_ctes("trips", "silver")

def _mean(name: str, rows: str, key: str) -> str:
    """Mean speed by ``key`` as a subquery: sums of 22 binary places each, then long division."""
    scale = "CAST(4194304 AS DOUBLE)"
    return f"""
{name}_0 AS (SELECT {key} AS k, trip_speed_kmh AS r FROM {rows} WHERE trip_speed_kmh IS NOT NULL),
{name}_1 AS (SELECT k, CAST(floor(r) AS BIGINT) AS p0, (r - floor(r)) * {scale} AS r FROM {name}_0),
{name}_2 AS (SELECT k, p0, CAST(floor(r) AS BIGINT) AS p1, (r - floor(r)) * {scale} AS r FROM {name}_1),
{name}_3 AS (SELECT k, p0, p1, CAST(floor(r) AS BIGINT) AS p2, (r - floor(r)) * {scale} AS r FROM {name}_2),
{name}_4 AS (
    SELECT k, count(*) AS n, CAST(sum(p0) AS BIGINT) AS s0, CAST(sum(p1) AS BIGINT) AS s1,
           CAST(sum(p2) AS BIGINT) AS s2, CAST(sum(CAST(floor(r) AS BIGINT)) AS BIGINT) AS s3
    FROM {name}_3 GROUP BY k
),
{name}_5 AS (SELECT *, s0 // n AS q0, (s0 % n) * 4194304 + s1 AS u1 FROM {name}_4),
{name}_6 AS (SELECT *, u1 // n AS q1, (u1 % n) * 4194304 + s2 AS u2 FROM {name}_5),
{name}_7 AS (SELECT *, u2 // n AS q2, ((u2 % n) * 4194304 + s3) // n AS q3 FROM {name}_6),
{name} AS (
    SELECT k, q0 + (q1 / {scale} + (q2 / {scale} / {scale} + q3 / {scale} / {scale} / {scale})) AS mean
    FROM {name}_7
)"""


_GOLD = (
    _mean("zone_mean", "(SELECT * FROM silver WHERE pickup_zone IS NOT NULL)", "pickup_zone")
    + """,
gold AS (
    SELECT pickup_zone, mean AS avg_speed_kmh, max(trip_speed_kmh) AS max_speed_kmh
    FROM silver JOIN zone_mean ON pickup_zone = k WHERE trip_speed_kmh IS NOT NULL
    GROUP BY pickup_zone, mean
)"""
)

_VALID = """
valid AS (
    SELECT *, date_diff('second', pickup_ts, dropoff_ts) / CAST(60 AS DOUBLE) AS minutes
    FROM (SELECT *, try_cast(tpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
                 try_cast(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts FROM trips)
    WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND dropoff_ts >= pickup_ts
)"""

_IN_ORDER = ", ".join(f'"{name}" NULLS FIRST' for name, _ in _FIELDS)

_NUMBERED = f"""
numbered AS (
    SELECT *, row_number() OVER (ORDER BY {_IN_ORDER}) AS n, count(*) OVER () AS total FROM trips
)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


_ALL_TRIPS = _with(_FIXTURES, select=f"SELECT {_WIRE} FROM trips")
_ALL_SILVER = _with(_FIXTURES, _SILVER, select="SELECT * FROM silver")
_ALL_GOLD = _with(_FIXTURES, _SILVER, _GOLD, select="SELECT * FROM gold")


def oracle_sql() -> dict[str, str]:
    found = dict(_TWINS)
    if corpus_queries:
        found |= corpus_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


_TWINS: dict[str, str] = {
    "zone_lookup": _with(_FIXTURES, select="SELECT LocationID, Zone FROM zones"),
    "trip_scan": _with(
        _FIXTURES,
        select="""SELECT * REPLACE (
            strftime(try_cast(tpep_pickup_datetime AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S')
                AS tpep_pickup_datetime) FROM trips""",
    ),
    "trip_scan_other_case": _with(
        _FIXTURES,
        select="SELECT "
        + ", ".join(
            f"""CASE WHEN "VendorID" % 3 = 2 THEN {name}
                ELSE strftime(try_cast({name} AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') END AS {name}"""
            if name.endswith("datetime")
            else f'"{name}"'
            if name in _KEPT_BY_SILVER
            else f'CASE WHEN "VendorID" % 3 = 2 THEN NULL ELSE "{name}" END AS "{name}"'
            for name, _ in _FIELDS
        )
        + " FROM trips",
    ),
    "trip_events_json": _with(
        _FIXTURES,
        select=f"""SELECT coalesce(CAST("VendorID" AS VARCHAR), '') AS event_key,
            CAST(20 AS INT) AS n_fields, {_WIRE} FROM trips""",
    ),
    "bronze_parse": _ALL_TRIPS,
    "vendor_order": _with(
        _FIXTURES,
        _NUMBERED,
        select="""SELECT coalesce(CAST("VendorID" AS VARCHAR), '') AS event_key,
            row_number() OVER (PARTITION BY "VendorID" ORDER BY n) - 1 AS sequence, n AS ordinal,
            tpep_pickup_datetime, fare_amount FROM numbered""",
    ),
    "bronze_stream": _ALL_TRIPS,
    "bronze_restart": _ALL_TRIPS,
    "bronze_inflight": _with(
        _FIXTURES,
        select='''SELECT "VendorID", count(*) AS row_count, CAST(0 AS BIGINT) AS batch
            FROM trips GROUP BY "VendorID"''',
    ),
    "bronze_schema": _with(
        _FIXTURES,
        select=" UNION ALL ".join(
            f"SELECT CAST({position} AS INT) AS position, '{name}' AS column_name, "
            f"'{kind}' AS data_type, "
            f'count("{name}") AS filled_rows FROM trips'
            for position, (name, kind) in enumerate(_FIELDS, start=1)
        ),
    ),
    "bronze_sample": _with(
        _FIXTURES,
        select="""SELECT "VendorID", tpep_pickup_datetime, "PULocationID", "DOLocationID",
            trip_distance, total_amount FROM trips
            ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST, 4 NULLS FIRST,
                     5 NULLS FIRST, 6 NULLS FIRST LIMIT 10""",
    ),
    "silver_valid_times": _with(
        _FIXTURES,
        _VALID,
        select="""SELECT "VendorID", pickup_ts, dropoff_ts, "PULocationID", "DOLocationID",
            fare_amount FROM valid""",
    ),
    "trip_duration": _with(
        _FIXTURES,
        _VALID,
        select="SELECT pickup_ts, dropoff_ts, minutes AS trip_duration_minutes FROM valid",
    ),
    "trip_speed": _with(
        _FIXTURES,
        _VALID,
        select="""SELECT minutes AS trip_duration_minutes, trip_distance,
            CAST(trip_distance IS NULL OR minutes <= 0 OR trip_distance <= 0 AS INT)
                AS speed_undefined,
            CASE WHEN minutes > 0 AND trip_distance > 0
                 THEN trip_distance / (minutes / 60) END AS trip_speed_kmh
            FROM valid""",
    ),
    "trips_with_zones": _with(
        _FIXTURES,
        select="""SELECT trips.*, a.Zone AS pickup_zone, b.Zone AS dropoff_zone FROM trips
            LEFT JOIN zones a ON "PULocationID" = a.LocationID
            LEFT JOIN zones b ON "DOLocationID" = b.LocationID""",
    ),
    "silver_dedup": _with(
        _FIXTURES,
        select="""SELECT fare_amount, trip_distance, tpep_pickup_datetime,
            tpep_dropoff_datetime, "VendorID", "PULocationID", "DOLocationID", payment_type,
            CAST(trunc(passenger_count) AS INT) AS passenger_count, tip_amount, total_amount
            FROM (SELECT *, row_number() OVER (
                PARTITION BY "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime,
                             "PULocationID", "DOLocationID", trip_distance, fare_amount
                ORDER BY payment_type NULLS FIRST, trunc(passenger_count) NULLS FIRST,
                         tip_amount NULLS FIRST, total_amount NULLS FIRST) AS rn FROM trips)
            WHERE rn = 1""",
    ),
    "silver_trips": _ALL_SILVER,
    "silver_publish": _ALL_SILVER,
    "gold_zone_speed": _ALL_GOLD,
    "gold_partitioned": _ALL_GOLD,
    "snapshot_history": _with(
        _FIXTURES,
        _SILVER,
        select=f"""SELECT CAST({HISTORY_COMMITS} + 1 - s AS INT) AS place, s AS sequence,
            'overwrite' AS operation, count(*) AS n_rows,
            CAST(s > {HISTORY_COMMITS} - 3 AS INT) AS readable
            FROM silver JOIN range(1, {HISTORY_COMMITS} + 1) AS r(s) ON vendor_id <= s
            WHERE s > {HISTORY_COMMITS} - 5 GROUP BY s""",
    ),
    "publish_conflict": _with(
        _FIXTURES,
        _SILVER,
        select="""SELECT s AS sequence, 'overwrite' AS operation, count(*) AS n_rows,
            CAST(1 AS INT) AS refused, count(*) AS latest_rows
            FROM silver, range(1, 3) AS r(s) GROUP BY s""",
    ),
    "speed_stats": _with(
        _FIXTURES,
        _SILVER,
        _mean("all_mean", "silver", "1"),
        select="""SELECT max(trip_speed_kmh) AS max_trip_speed_kmh,
            (SELECT mean FROM all_mean) AS avg_trip_speed_kmh,
            CAST(sum(CASE WHEN trip_speed_kmh IS NULL THEN 1 ELSE 0 END) AS BIGINT)
                AS null_speed_rows,
            count(*) AS total_rows FROM silver""",
    ),
    "layer_counts": _with(
        _FIXTURES,
        _SILVER,
        _GOLD,
        select="""SELECT 'bronze' AS layer, count(*) AS row_count FROM trips
            UNION ALL SELECT 'silver', count(*) FROM silver
            UNION ALL SELECT 'gold', count(*) FROM gold""",
    ),
    "top_zones": _with(
        _FIXTURES,
        _SILVER,
        _GOLD,
        select="SELECT * FROM gold ORDER BY max_speed_kmh DESC, pickup_zone LIMIT 10",
    ),
    "adhoc_sql": _with(_FIXTURES, select="SELECT count(*) AS row_count FROM trips"),
    "adhoc_sql_sample": _with(
        _FIXTURES,
        _SILVER,
        select="""SELECT * FROM silver
            ORDER BY fare_amount DESC, trip_distance DESC NULLS LAST, pickup_datetime,
                     dropoff_datetime, vendor_id, pu_location_id, do_location_id LIMIT 3""",
    ),
    "replay_schedule": _with(
        _FIXTURES,
        _NUMBERED,
        select=f"""SELECT n AS ordinal,
            CAST(floor((n - 1) / CAST({REPLAY_RATE} AS DOUBLE)) AS BIGINT) AS release_second,
            "VendorID", tpep_pickup_datetime, "PULocationID", "DOLocationID", fare_amount
            FROM numbered""",
    ),
    "replay_passes": _with(
        _FIXTURES,
        _NUMBERED,
        select=f"""SELECT CAST(p AS INT) AS pass, (p - 1) * total + n AS ordinal,
            CAST(floor(((p - 1) * total + n - 1) / CAST({REPLAY_RATE} AS DOUBLE)) AS BIGINT)
                AS release_second,
            "VendorID", tpep_pickup_datetime, "PULocationID", "DOLocationID", fare_amount
            FROM numbered, range(1, {REPLAY_PASSES + 1}) AS passes(p)""",
    ),
    "replay_progress": _with(
        _FIXTURES,
        _NUMBERED,
        select=f"""SELECT report, n AS sent, tpep_pickup_datetime, "PULocationID", "DOLocationID",
            fare_amount, (n - 1) / CAST({REPLAY_RATE} AS DOUBLE) AS elapsed_seconds,
            CASE WHEN n > 1 THEN n / ((n - 1) / CAST({REPLAY_RATE} AS DOUBLE)) END AS events_per_second
            FROM (SELECT *, CASE WHEN n = 1 THEN 0 ELSE CAST(ceil(n / CAST(100 AS DOUBLE)) AS BIGINT)
                            END AS report FROM numbered)
            WHERE n = 1 OR n % 100 = 0 OR n = total""",
    ),
    "replay_paced": _with(
        _FIXTURES,
        _NUMBERED,
        select=f"""SELECT n AS ordinal, (n - 1) // {PACED_SHARE} AS batch,
            "VendorID", tpep_pickup_datetime, "PULocationID", "DOLocationID", fare_amount
            FROM numbered""",
    ),
    "replay_paced_passes": _with(
        _FIXTURES,
        _NUMBERED,
        select=f"""SELECT (p - 1) * total + n AS ordinal,
            ((p - 1) * total + n - 1) // {PACED_SHARE} AS batch,
            "VendorID", tpep_pickup_datetime, "PULocationID", "DOLocationID", fare_amount
            FROM numbered, range(1, {REPLAY_PASSES + 1}) AS passes(p)""",
    ),
    "replay_live_report": _with(
        _FIXTURES,
        _NUMBERED,
        select=f"""SELECT (n - 1) // {PACED_SHARE} AS batch, n AS sent,
            tpep_pickup_datetime, "PULocationID", "DOLocationID", fare_amount
            FROM numbered WHERE n = 1 OR n % 100 = 0 OR n = total""",
    ),
}
