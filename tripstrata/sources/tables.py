"""Full-refresh tables.

``CatalogTable`` is for a catalog that can replace tables in one step and keeps their
history, as Iceberg does. Elsewhere ``VersionedTable`` writes every refresh into a folder
of its own and commits it by adding one row to a commit log, so readers see the old version
or the new one, and a failed write changes nothing. Both are used alike.

Writers do not wait for one another. A writer claims the next sequence number by a file that
only one can create; who finds it claimed has lost, and takes a later one or gives up. A
writer that dies between claim and commit leaves a gap in the numbers and nothing else.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tripstrata.operators.aggregate import counted
from tripstrata.schemas import COMMIT_LOG
from tripstrata.sources.files import names_and_ages, put_if_absent, remove_folder

EXPIRED = "expire"


class Conflict(RuntimeError):
    """Another writer has committed since the version that a refresh was made from."""


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows that are counted while they are written, so the plan runs once."""
    n_rows = Observation()
    return rows.observe(n_rows, F.count(F.lit(1)).alias("n_rows")), n_rows


class CatalogTable:
    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: StructType,
        fmt: str = "iceberg",
        partition_by: list[str] | None = None,
    ) -> None:
        self.spark = spark
        self.name = name
        self.schema = schema
        self.fmt = fmt
        self.partition_by = partition_by or []

    def history(self) -> DataFrame:
        snapshots = self.spark.table(f"{self.name}.snapshots")
        return snapshots.select("snapshot_id", "committed_at", "operation")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def publish(self, rows: DataFrame) -> int:
        """Create or replace the table in one transaction; returns the rows written."""
        counted, n_rows = _counted(rows.select(*self.schema.names))
        writer = counted.writeTo(self.name).using(self.fmt)
        if self.partition_by:
            writer = writer.partitionedBy(*(F.col(c) for c in self.partition_by))
        writer.createOrReplace()
        return int(n_rows.get["n_rows"])

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def row_count(self) -> DataFrame:
        return counted(self.read())


def footer_count(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``row_count`` of Parquet files from their footers; no row group is opened.

    Spark takes counts from footers only for a reader that is not its default one, so this
    one query has a session of its own. A folder that a stream writes counts what it committed.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return counted(own.read.schema(schema).parquet(path))


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        partition_by: list[str] | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by or []

    def _log(self) -> DataFrame:
        """All log rows, each once; a compacted row may still stand in its own file as well."""
        if not names_and_ages(self.spark, f"{self.root}/_commits"):
            return self.spark.createDataFrame([], COMMIT_LOG)
        reader = self.spark.read.schema(COMMIT_LOG).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.root}/_commits").dropDuplicates(["snapshot_id"])

    def history(self) -> DataFrame:
        """The commits, empty before the first; those of expired versions stay listed."""
        return self._log().where(F.col("operation") != EXPIRED)

    def readable(self) -> DataFrame:
        """The commits whose versions can still be read."""
        log = self._log()
        gone = log.where(F.col("operation") == EXPIRED).select("folder")
        return log.where(F.col("operation") != EXPIRED).join(gone, "folder", "left_anti").select(
            *COMMIT_LOG.names
        )

    def latest(self) -> Row | None:
        return self.history().orderBy(F.desc("sequence"), F.desc("committed_at")).first()

    def exists(self) -> bool:
        return self.latest() is not None

    def publish(
        self, rows: DataFrame, operation: str = "overwrite", expected: int | None = None
    ) -> int:
        """Write all rows as the next version and commit it; returns their number.

        Of writers at the same time each gets a number of its own, and the last is what
        readers see. With ``expected``, the sequence number that ``rows`` were made from (0
        for none), a writer that comes second raises ``Conflict`` and changes nothing.
        """
        last = self.latest()
        base = last.sequence if last else 0
        if expected is not None and expected != base:
            raise Conflict(f"{self.root} is at version {base}, not {expected}")
        folder = uuid.uuid4().hex
        counted, observed = _counted(rows.select(*self.schema.names))
        counted.write.partitionBy(*self.partition_by).parquet(f"{self.root}/{folder}")
        n_rows = int(observed.get["n_rows"])
        self._commit(folder, operation, self._claim(base + 1, expected is not None), n_rows)
        return n_rows

    def _claim(self, sequence: int, only: bool) -> int:
        """A sequence number that no other writer has: ``sequence`` or, unless ``only``, a later one."""
        while not put_if_absent(self.spark, f"{self.root}/_claims/{sequence:020d}"):
            if only:
                raise Conflict(f"another writer committed version {sequence} of {self.root}")
            last = self.latest()
            sequence = max(sequence, last.sequence if last else 0) + 1
        return sequence

    def _commit(self, folder: str, operation: str, sequence: int, n_rows: int) -> None:
        values = {
            "snapshot_id": F.lit(uuid.uuid4().int >> 65),
            "committed_at": F.current_timestamp(),
            "operation": F.lit(operation),
            "sequence": F.lit(sequence),
            "folder": F.lit(folder),
            "n_rows": F.lit(n_rows),
        }
        entry = self.spark.range(0, 1, 1, 1).select(
            *(values[f.name].cast(f.dataType).alias(f.name) for f in COMMIT_LOG)
        )
        # A folder for each commit, as writers of one folder clear away each other's work.
        entry.write.parquet(f"{self.root}/_commits/{operation}-{sequence:020d}-{folder}")

    def compact_log(self) -> None:
        """Put the log into one file.

        Files that it replaces are removed by the next compaction, not by this one, so that
        a reader that listed them before still finds them.
        """
        names = names_and_ages(self.spark, f"{self.root}/_commits")
        if not names:
            return
        whole = f"whole-{uuid.uuid4().hex}"
        noted = self.spark.createDataFrame([(n,) for n in sorted(names)], "name string")
        replaced = f"{self.root}/_compacted"
        for name in self._replaced(replaced):
            remove_folder(self.spark, f"{self.root}/_commits/{name}")
        self._log().coalesce(1).write.parquet(f"{self.root}/_commits/{whole}")
        noted.coalesce(1).write.mode("overwrite").parquet(replaced)

    def _replaced(self, path: str) -> list[str]:
        if not names_and_ages(self.spark, path):
            return []
        return [r.name for r in self.spark.read.schema("name string").parquet(path).collect()]

    def expire(self, keep: int = 5, grace_seconds: float = 86_400) -> int:
        """Remove old versions' rows; returns how many versions went.

        The newest ``keep`` versions stay, and so does every version that was the latest
        within ``grace_seconds``: a reader that opened it then may still be at work. A
        version is logged as expired before its rows go. Folders of writers that never
        committed go when they are as old.
        """
        if keep < 1:
            raise ValueError("the latest version always stays")
        newest = Window.orderBy(F.desc("sequence"), F.desc("committed_at"))
        # One row for each version that is left, which is what expiry keeps few.
        left = self.readable().select(
            "folder",
            "sequence",
            F.row_number().over(newest).alias("rank"),
            F.lag("committed_at").over(newest).alias("until"),
        )
        limit = F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(grace_seconds)))
        old = left.where((F.col("rank") > keep) & (F.col("until") <= limit)).collect()
        for version in old:
            self._commit(version.folder, EXPIRED, version.sequence, 0)
            remove_folder(self.spark, f"{self.root}/{version.folder}")
        known = {r.folder for r in self._log().select("folder").collect()}
        for name, age in names_and_ages(self.spark, self.root).items():
            if name[0] not in "_." and name not in known and age > grace_seconds:
                remove_folder(self.spark, f"{self.root}/{name}")
        return len(old)

    def row_count(self) -> DataFrame:
        """``row_count`` of the latest version, as its commit noted it; rows are not read."""
        newest = self.history().orderBy(F.desc("sequence"), F.desc("committed_at")).limit(1)
        return newest.select(F.col("n_rows").alias("row_count"))

    def read(self) -> DataFrame:
        """The latest committed version, with the published types and column order."""
        last = self.latest()
        if last is None:
            raise LookupError(f"nothing was published to {self.root}")
        return self.read_version(last.folder)

    def read_version(self, folder: str) -> DataFrame:
        try:
            stored = self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise LookupError(f"version {folder} of {self.root} has expired") from error
        return stored.select(*(self._column(f.name) for f in self.schema))

    def _column(self, name: str):
        # A partition folder stores empty text like null, and no null text is published
        # in a partition column.
        if name in self.partition_by and isinstance(self.schema[name].dataType, StringType):
            return F.coalesce(F.col(name), F.lit("")).alias(name)
        return F.col(name)
