"""Silver and gold as lazy plans, and where a set of layers is kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.operators.aggregate import counted, zone_speed
from tripstrata.operators.cleaning import (
    needed_fields,
    valid_times,
    with_duration,
    with_speed,
    with_times,
)
from tripstrata.operators.dedup import one_per_key
from tripstrata.operators.enrich import with_zones
from tripstrata.schemas import GOLD, SILVER, TRIP_KEY, TRIP_REST, TRIP_WIRE
from tripstrata.sources.tables import CatalogTable, VersionedTable, footer_count
from tripstrata.streaming.bronze import create_bronze_table, read_bronze, read_bronze_at

# The wire or derived field behind every published silver column.
_SILVER_FROM = {
    "vendor_id": "VendorID",
    "pickup_datetime": "pickup_ts",
    "dropoff_datetime": "dropoff_ts",
    "pu_location_id": "PULocationID",
    "do_location_id": "DOLocationID",
}


def silver_columns(trips: DataFrame) -> DataFrame:
    """Rename and cast to the published silver schema."""
    return trips.select(
        *(
            F.col(_SILVER_FROM.get(f.name, f.name)).cast(f.dataType).alias(f.name)
            for f in SILVER
        )
    )


def distinct_trips(bronze: DataFrame) -> DataFrame:
    """Valid trips, each once."""
    return one_per_key(valid_times(needed_fields(bronze)), TRIP_KEY, TRIP_REST)


def build_silver(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    """Bronze to silver.

    Filters run in the scan's stage, and the one shuffle of trips is the dedup. It
    carries neither zone names nor parsed times: parsing twice costs less than moving the
    results. Names are added after it, which gives the same rows because both location
    ids are part of the key.
    """
    timed = with_duration(with_times(distinct_trips(bronze)))
    return silver_columns(with_zones(with_speed(timed), zones))


def build_gold(silver: DataFrame) -> DataFrame:
    return zone_speed(silver)


@dataclass(frozen=True)
class Layers:
    """One set of tables below a folder. The bronze checkpoint stays beside its table."""

    root: str
    bronze_path: str | None = None

    @property
    def bronze(self) -> str:
        return self.bronze_path or f"{self.root}/bronze"

    @property
    def checkpoint(self) -> str:
        return f"{self.bronze}_checkpoint"

    def prepare(self, spark: SparkSession) -> None:
        """Folders need no declaration."""

    def bronze_sink(self) -> dict[str, str]:
        return {"path": self.bronze}

    def read_bronze(self, spark: SparkSession) -> DataFrame:
        return read_bronze(spark, self.bronze)

    def bronze_at(self, spark: SparkSession) -> tuple[DataFrame, int | None]:
        return read_bronze_at(spark, self.bronze)

    def count_bronze(self, spark: SparkSession) -> DataFrame:
        return footer_count(spark, self.bronze, TRIP_WIRE)

    def silver(self, spark: SparkSession) -> VersionedTable:
        return VersionedTable(spark, f"{self.root}/silver", SILVER)

    def gold(self, spark: SparkSession) -> VersionedTable:
        return VersionedTable(spark, f"{self.root}/gold", GOLD, ["pickup_zone"])


@dataclass(frozen=True)
class CatalogLayers:
    """One set of tables in a catalog database, such as ``lake.trips``."""

    database: str
    checkpoint: str
    fmt: str = "iceberg"

    def prepare(self, spark: SparkSession) -> None:
        create_bronze_table(spark, f"{self.database}.bronze", self.fmt)

    def bronze_sink(self) -> dict[str, str]:
        return {"table": f"{self.database}.bronze", "fmt": self.fmt}

    def read_bronze(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.database}.bronze")

    def bronze_at(self, spark: SparkSession) -> tuple[DataFrame, int | None]:
        """A catalog's own snapshots bind a read; they are not the stream's batches."""
        return self.read_bronze(spark), None

    def count_bronze(self, spark: SparkSession) -> DataFrame:
        return counted(self.read_bronze(spark))

    def silver(self, spark: SparkSession) -> CatalogTable:
        return CatalogTable(spark, f"{self.database}.silver", SILVER, self.fmt)

    def gold(self, spark: SparkSession) -> CatalogTable:
        return CatalogTable(spark, f"{self.database}.gold", GOLD, self.fmt, ["pickup_zone"])
