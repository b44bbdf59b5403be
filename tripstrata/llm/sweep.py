"""Rows dealt out in sorted order, and what a sweep carries from one part into the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep


def width(spark: SparkSession) -> int:
    """Parts that a sorted table is dealt into: as many as its shuffles start with."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    return int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` in ranges of ``order``, each named by ``part``, as a table of their own.

    The table is written, so that a lost executor cannot deal rows out another way. Where
    ``order`` tells rows apart, no value can make a part large.
    """
    parts = rows.repartitionByRange(width(rows.sparkSession), *order)
    return keep(parts.withColumn("part", F.spark_partition_id()), "parts")


def running(*order: str, by: tuple[str, ...] = ("part",)):
    """The rows of a part up to this one."""
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def carried(totals: DataFrame, key: str, **combine) -> DataFrame:
    """What the parts before have of a part's first ``key``: at most one row for each part.

    ``totals`` has ``part``, ``key`` and one value of each name in ``combine`` for every key
    of a part, ``combine`` the aggregate that adds values of several parts up. Parts are
    ranges, so only the first key of a part can have begun before; the rows that are looked
    at are no more than two for each part.
    """
    firsts = totals.groupBy("part").agg(F.min(key).alias("first"))
    ends = F.broadcast(firsts.select(F.col("first").alias(key)).distinct())
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"{name}_before": use(name).over(before) for name, use in combine.items()}
    some = totals.join(ends, key, "left_semi").withColumns(sums).drop(*combine)
    return some.where(" and ".join(f"{name} is not null" for name in sums))
