"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep


def _to_least(pairs: DataFrame, larger: bool) -> DataFrame:
    """Tie the neighbours of every node to the least among them and the node itself.

    With ``larger`` only neighbours above the node are tied, else all but the least one.
    """
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if larger:
        ends = ends.unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))
    else:
        ends = pairs.select(
            F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")
        )
    least = ends.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    tied = ends.join(least, "node")
    if larger:
        tied = tied.where(F.col("other") > F.col("node"))
        return tied.select(F.col("other").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    rest = tied.where(F.col("other") != F.col("least")).select(
        F.col("other").alias("a"), F.col("least").alias("b")
    )
    return own.unionByName(rest)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node it is joined with, for every linked node.

    Large-star and small-star steps alternate until nothing changes. Each needs one
    aggregate with a map-side part and one join that adaptive execution can split, so a
    component of any size never meets in one task. Links of a node with itself, repeated
    links and links with a null end are ignored.
    """
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    pairs = keep(pairs.where("a != b").distinct(), "links")
    before = None
    while True:
        pairs = _to_least(_to_least(pairs, True).where("a != b"), False)
        pairs = keep(pairs.where("a != b").distinct(), "links")
        sums = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if sums == before:
            break
        before = sums
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
