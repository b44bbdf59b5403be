"""Prefix trie of conversations, rolled up over bands of depths.

A node is a distinct sequence of first turns; its members are the conversations that start
with it. A prefix is known by the exclusive or of the digests of its turns, each taken with
its place (120 bits), which adds up over pieces of a conversation. So a conversation of any
length is dealt out by ranges of its turns, and what a piece needs of the ones before, the
number of turns and the digest so far, is one row for each part. Every node is checked to
have one last turn and depth; should digests of unlike prefixes ever agree, the job ends
with an error.

Sums over subtrees use one member of each node, its smallest. On that member's own path
stand the keys of all its ancestors, so no node looks for its parent:

1. A node adds to its ancestors within its band of depths only, of which there are no more
   than the band is high. This completes what each band holds below each of its nodes.
2. The tops of bands add theirs to the tops above them, as many at most as there are bands.
3. The completed tops add to their ancestors in the band above.

With a height near the root of the greatest depth, the three steps are the only rounds, and
neither the ancestors of a node nor those of a top exceed that root. Steps run as windows over
one conversation's band or tops, and as sums by key with a map-side part, so that a node that
all conversations share is one row of a task. Texts do not leave the scan's stage: a turn is
its digest and its number of words.

Turns stand by ``turn``, null first; of one turn number, by the digest of role and text. A
null role or text is empty; equal rows stay, as turns of their own. Rows without a
conversation's id are ignored. Other columns are left out, whatever their names. Tables
without conversations have no node, not even the root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep
from tripstrata.llm.sweep import carried, dealt, running

WORD = r"[^\x20\x09-\x0D]+"
#: Shared first turns: a conversation takes up to three of the one that leads its twenty.
FAMILY, MOST_SHARED = 20, 3


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 1, ``digest`` and ``n_words`` of every turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = F.concat_ws(":", F.length(role).cast("string"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(said, 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    order = ("turn", "digest", "row_id")
    parts = dealt(rows, "conv_id", *order)
    counts = parts.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    before = F.broadcast(carried(counts, "conv_id", n=F.sum))
    place = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    placed = parts.withColumn("place", place).join(before, ["part", "conv_id"], "left")
    pos = F.col("place") + F.coalesce("n_before", F.lit(0))
    return keep(placed.select("conv_id", pos.alias("pos"), "digest", "n_words"), "turns")


def with_shared_starts(turns: DataFrame) -> DataFrame:
    """Turns of every conversation after its first ones were taken from its family's leader.

    Each conversation has a row of depth 0, without a digest, and one for each turn;
    ``length`` is the number of turns.
    """
    first = F.when(F.col("pos") <= MOST_SHARED, F.struct("pos", "digest", "n_words"))
    convs = keep(
        turns.groupBy("conv_id").agg(
            F.max("pos").alias("own"), F.sort_array(F.collect_list(first)).alias("first")
        ),
        "conversations",
    )
    leaders = convs.select(F.col("conv_id").alias("leader"), F.col("first").alias("led"))
    share = F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)
    taken = convs.select(
        "conv_id",
        "own",
        share.cast("int").alias("share"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("leader"),
    ).join(leaders, "leader", "left")
    led = F.coalesce(F.slice("led", 1, F.col("share")), F.array().cast(convs.schema["first"].dataType))
    rebuilt = keep(
        taken.withColumn("led", led).select(
            "conv_id",
            "share",
            "led",
            (F.size("led") + F.greatest(F.col("own") - F.col("share"), F.lit(0))).alias("length"),
        ),
        "rebuilt",
    )
    start = rebuilt.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("n_words"),
        "length",
    )
    shared = rebuilt.select("conv_id", "length", F.inline("led")).select(
        "conv_id", F.col("pos").cast("long").alias("depth"), "digest", "n_words", "length"
    )
    # The lookup side was written, so that a conversation of very many turns can be split.
    own = turns.join(rebuilt.select("conv_id", "share", F.size("led").alias("n_led"), "length"), "conv_id")
    own = own.where("pos > share").select(
        "conv_id",
        (F.col("n_led") + F.col("pos") - F.col("share")).cast("long").alias("depth"),
        "digest",
        "n_words",
        "length",
    )
    return start.unionByName(shared).unionByName(own)


def _bits(digest: Column, lane: int) -> Column:
    """60 bits of a hexadecimal digest as a number."""
    return F.conv(F.substring(digest, 1 + 15 * lane, 15), 16, 10).cast("long")


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """Every conversation at every depth, with the key ``a``, ``b`` of its prefix."""
    placed = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("digest")), 256)
    here = (F.coalesce(_bits(placed, lane), F.lit(0)).alias(f"turn_{n}") for lane, n in enumerate("ab"))
    last = F.coalesce(_bits(F.hex("digest"), 0), F.lit(0)).alias("last")
    rows = rebuilt.select("conv_id", "depth", "n_words", last, (F.col("depth") == F.col("length")).alias("ends"), *here)
    parts = dealt(rows, "conv_id", "depth")
    totals = parts.groupBy("part", "conv_id").agg(*(F.bit_xor(f"turn_{n}").alias(n) for n in "ab"))
    before = F.broadcast(carried(totals, "conv_id", a=F.bit_xor, b=F.bit_xor))
    so_far = running("depth", by=("part", "conv_id"))
    sums = {f"here_{n}": F.bit_xor(f"turn_{n}").over(so_far) for n in "ab"}
    placed_rows = parts.withColumns(sums).join(before, ["part", "conv_id"], "left")
    keys = [
        F.col(f"here_{n}").bitwiseXOR(F.coalesce(f"{n}_before", F.lit(0))).alias(n) for n in "ab"
    ]
    return keep(
        placed_rows.select("conv_id", "depth", "n_words", "last", "ends", "turn_a", "turn_b", *keys),
        "prefixes",
    )


def _nodes(prefixes: DataFrame) -> DataFrame:
    """One row for each prefix: smallest member, members, words of the last turn, parent's key."""
    above = [F.max(F.col(n).bitwiseXOR(F.col(f"turn_{n}"))).alias(f"above_{n}") for n in "ab"]
    one = (F.col("depth") == F.col("least_depth")) & (F.col("last") == F.col("least_last"))
    return (
        prefixes.groupBy("a", "b")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("n_words").alias("n_words"),
            *(F.max(c).alias(c) for c in ("depth", "last")),
            *(F.min(c).alias(f"least_{c}") for c in ("depth", "last")),
            *above,
        )
        .withColumn("depth", F.when(one, F.col("depth")).otherwise(F.raise_error(F.lit("digests of prefixes agree"))))
        .drop("last", "least_last", "least_depth")
    )


def _upwards(path: DataFrame, group: Column) -> DataFrame:
    """Sums of ``leaves`` and ``tokens`` at or below every step of a path, by node."""
    steps = Window.partitionBy("conv_id", group).orderBy(F.desc("depth"))
    below = steps.rowsBetween(Window.unboundedPreceding, 0)
    sums = {n: F.sum(n).over(below) for n in ("leaves", "tokens")}
    met = path.withColumns(sums).where("leaves is not null")
    return met.groupBy("a", "b").agg(*(F.sum(n).alias(n) for n in ("leaves", "tokens")))


def _subtrees(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``leaves`` and ``tokens`` of every node's subtree, by key."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    height = max(4, math.isqrt(deepest) + 1)
    own = nodes.select("conv_id", "depth", "leaves", "tokens")
    paths = prefixes.select("conv_id", "depth", "a", "b")
    band = F.floor(F.col("depth") / height)
    inside = keep(_upwards(paths.join(own, ["conv_id", "depth"], "left"), band), "bands")

    is_top = F.col("depth") % height == 0
    tops = nodes.where(is_top).select("a", "b", "conv_id", "depth")
    held = tops.join(inside, ["a", "b"]).drop("a", "b")
    lines = paths.where(is_top).join(held, ["conv_id", "depth"], "left")
    whole = _upwards(lines, F.lit(0))

    # A completed top stands at the foot of the band above it.
    foot = tops.where("depth > 0").join(whole, ["a", "b"]).drop("a", "b")
    foot = foot.withColumnRenamed("depth", "below")
    beyond = paths.withColumn("below", ((band + 1) * height).cast("long")).join(foot, ["conv_id", "below"])
    return inside.unionByName(beyond.select(*inside.columns)).groupBy("a", "b").agg(
        *(F.sum(n).alias(n) for n in ("leaves", "tokens"))
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` by key: the ids that end there, ascending, as one text.

    The text of a node may be as long as a share of the table, and a digest is made from its
    start to its end. So ids are sorted and joined to pieces in ranges, and the pieces of a
    node pass one after the other through one task, which holds none but the one at hand.
    """
    parts = dealt(ends, "a", "b", "conv_id")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = parts.groupBy("part", "a", "b").agg(F.array_join(ids, ",").alias("ids"))
    schema = "a long, b long, ends_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if (a, b) != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _digests(done)
        if key:
            yield _digests([(*key, state.hexdigest())])

    dealt_out = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "part")
    return dealt_out.select("a", "b", "ids").mapInArrow(digest, schema)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "b", "ends_sha256"]
    )


def prefix_trie(rebuilt: DataFrame) -> DataFrame:
    """Every node of the trie of conversations that are given as by ``with_shared_starts``."""
    prefixes = _prefixes(rebuilt)
    found = keep(_nodes(prefixes), "nodes")
    children = (
        found.where("depth > 0")
        .groupBy(F.col("above_a").alias("a"), F.col("above_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    n_children = F.coalesce("n_children", F.lit(0))
    nodes = keep(
        found.join(children, ["a", "b"], "left")
        .withColumn("n_children", n_children)
        .withColumn("leaves", (n_children == 0).cast("long"))
        .withColumn("tokens", (F.col("n_convs") - 1) * F.col("n_words")),
        "trie",
    )
    ends = _end_digests(prefixes.where("ends").select("a", "b", "conv_id"))
    sums = _subtrees(prefixes, nodes)
    parents = found.select(
        F.col("a").alias("above_a"), F.col("b").alias("above_b"), F.col("conv_id").alias("parent")
    )
    # Both sides were written: a node with very many children can be split.
    under = nodes.drop("leaves", "tokens").join(parents, ["above_a", "above_b"], "left")
    return (
        under.join(sums, ["a", "b"])
        .join(ends, ["a", "b"], "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("tokens").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, rebuilt with the first turns that their families share."""
    return prefix_trie(with_shared_starts(_turns(conversations)))
