"""URL rules of hosts and path prefixes, joined to URLs by a sorted sweep. No Python workers.

A rule fits its host and every subdomain, where the URL's path starts with the rule's. Its
canonical key is the host with its labels in reverse, each ended by a dot, and the path:
``example.net/en/`` is ``net.example./en/``. A URL stands in the same order once for every
number of labels that a rule may have (``net./en/x``, ``net.example./en/x``), and a rule fits
where its key starts such a key. Keys that start alike stand together, so each rule is an
interval, and intervals nest or are apart.

The sweep goes through rules and URLs in the order of their keys. Every rule carries the
stack of rules that are open where it stands. The rules open at a URL are those of the last
rule before it whose key starts the URL's: a rule that is open at the URL was opened at or
before that last rule, and is open there as well. Rules and URLs are dealt out in ranges of
key and row, so that a host, a path or a URL may hold any share of the rows; what is open
where a part begins comes from the parts before it, as one row for each part.

The longest fitting rule, host and path together, wins; of two as long, that of the longer
host. A rule given twice with different verdicts blocks. A rule with a null field, or a path
that is neither empty nor starts with ``/``, fits nothing. Without a fitting rule the verdict
is ``default``. A null URL, and one without ``://``, has an empty host and path, which only
a rule of the empty host fits. Keys are cut where the longest rule ends, so that long URLs
cost no more. Repeated rows stay, each with its verdict. Columns of the input come back in
the struct ``rest`` whatever their names; tables without rows give none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep
from tripstrata.llm.sweep import dealt, running, width

#: Rules whose stacks are worked out together, about.
RULE_BLOCK = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/``, ``?``, ``#``, then up to ``?``, ``#``."""
    mark = F.locate("://", url)
    after = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, "\\."))


def _key(labels: Column, depth: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.slice(labels, 1, depth), "."), F.lit("."), path)


def _keyed(rules: DataFrame) -> DataFrame:
    """Each rule once, by its key."""
    usable = rules.where("host is not null and verdict is not null").where(
        (F.col("path") == "") | F.startswith("path", F.lit("/"))
    )
    host = F.translate("host", UPPER, LOWER)
    labels = _labels(host)
    return (
        usable.select(
            _key(labels, F.size(labels), F.col("path")).alias("key"),
            F.concat(host, "path").alias("rule"),
            F.size(labels).alias("depth"),
            "verdict",
        )
        .groupBy("key", "rule", "depth")
        .agg(F.max("verdict").alias("verdict"))
    )


def _opened(rules: DataFrame) -> DataFrame:
    """``key`` of every rule and ``stack``: the rules open at it, itself last.

    Blocks of rules in the order of their keys are swept each for itself. What is open where
    a block begins are the rules whose keys start its first key; so a stack is no longer
    than a key.
    """
    blocks = math.ceil(max(1, rules.count()) / RULE_BLOCK)
    entry = F.struct("key", "rule", "depth", "verdict")
    sorted_rules = keep(
        rules.repartitionByRange(blocks, "key").select(F.spark_partition_id().alias("block"), entry.alias("entry")),
        "rules",
    )
    block = sorted_rules.groupBy("block").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    block = block.withColumn("head", F.col("entries")[0]["key"])
    starts = block.select(
        "block",
        F.explode(F.sequence(F.lit(1), F.length("head"))).alias("n"),
        "head",
    ).where("n < length(head)")
    found = starts.select("block", F.expr("substring(head, 1, n)").alias("start")).join(
        sorted_rules.select("entry"), F.col("start") == F.col("entry.key")
    )
    before = found.groupBy("block").agg(F.sort_array(F.collect_list("entry")).alias("open"))

    def step(state: Column, rule: Column) -> Column:
        still = F.filter(state["open"], lambda r: F.startswith(rule["key"], r["key"]))
        stack = F.concat(still, F.array(rule))
        done = F.struct(rule["key"].alias("key"), stack.alias("stack"))
        return F.struct(stack.alias("open"), F.concat(state["done"], F.array(done)).alias("done"))

    kind = "struct<key:string,rule:string,depth:int,verdict:string>"
    none = F.array().cast(f"array<struct<key:string,stack:array<{kind}>>>")
    start = F.struct(
        F.coalesce("open", F.array().cast(f"array<{kind}>")).alias("open"), none.alias("done")
    )
    swept = block.join(before, "block", "left").select(
        F.inline(F.aggregate("entries", start, step, lambda state: state["done"]))
    )
    return swept.select("key", "stack")


def filter_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` of every row's URL, and its columns as ``rest``.

    ``rules`` has ``host``, ``path`` and ``verdict``; a host, its path and its rules may be any
    number. ``rule`` is the winner's host and path in one, null where none fits.
    """
    spark = pages.sparkSession
    ruled = keep(_keyed(rules), "url-rules")
    most = ruled.agg(F.max("depth"), F.max(F.length("key"))).first()
    depth, length = most[0] or 1, most[1] or 1
    host, path = url_parts(F.col(f"`{url_col}`"))
    rows = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("rest"),
        host.alias("host"),
        path.alias("path"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    labels = _labels(F.col("host"))
    depths = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth)))
    points = rows.select("*", F.explode(depths).alias("level")).select(
        F.substring(_key(labels, F.col("level"), F.expr(f"substring(path, 1, {length})")), 1, length).alias("key"),
        "row_id",
        # A row's own columns travel with the first of its keys only.
        *(F.when(F.col("level") == 1, F.col(c)).alias(c) for c in ("host", "path", "rest")),
    )
    opened = _opened(ruled).select("key", F.lit(-1).cast("long").alias("row_id"), "stack")
    swept = dealt(points.unionByName(opened, allowMissingColumns=True), "key", "row_id")

    # What is open where a part begins: the stack of the last rule before it.
    last = swept.where("row_id = -1").groupBy("part").agg(F.max_by("stack", "key").alias("stack"))
    every = spark.range(width(spark)).select(F.col("id").cast("int").alias("part"))
    carried = F.last("stack", ignorenulls=True).over(running("part", by=()).rowsBetween(-(1 << 31), -1))
    before = every.join(last, "part", "left").select("part", carried.alias("stack"))
    first = before.where("stack is not null").select(
        F.lit("").alias("key"), F.lit(-2).cast("long").alias("row_id"), "stack", "part"
    )
    events = swept.unionByName(first, allowMissingColumns=True)
    stack = F.last("stack", ignorenulls=True).over(running("key", "row_id"))
    fitting = F.filter("open", lambda r: F.startswith(F.col("key"), r["key"]))
    met = (
        events.withColumn("open", stack)
        .where("row_id >= 0")
        .withColumn("top", F.try_element_at(fitting, F.lit(-1)))
    )
    best = F.max(
        F.when(
            F.col("top").isNotNull(),
            F.struct(F.length("top.rule"), "top.depth", "top.rule", "top.verdict"),
        )
    ).alias("best")
    kept = (F.first(c, ignorenulls=True).alias(c) for c in ("host", "path", "rest"))
    return (
        met.groupBy("row_id")
        .agg(best, *kept)
        .select(
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
            "rest",
        )
    )
