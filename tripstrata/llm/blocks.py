"""Texts kept in blocks, and questions that blocks put to one another about hashes.

A corpus is written once as a table bucketed by block, a few megabytes of whole texts each.
Every later pass reads a block where it lies, so the text itself is not shuffled again.
A block asks about a hash once, however often it holds it: a hash that a third of all rows
share reaches a bucket as one value per block. An answer is one bit for each asked hash, in
the order of asking, which the block works out again from its text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripstrata.sources.session import CODEC
from tripstrata.sources.workspace import new_folder

BLOCK_BYTES = 4 << 20
#: Hashes that one bucket of an exchange should get, about.
BUCKET_HASHES = 1 << 19

ASKED = "block long, level int, bucket int, n int, hashes binary, more binary"
ANSWERED = "block long, level int, bucket int, bits binary"


def n_blocks(docs: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks for the texts of ``docs``, whose bytes are counted; estimates can be far off."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def bucket_bits(blocks: int, per_block: int) -> int:
    """Bits of a hash that name its bucket, so that a bucket stays near ``BUCKET_HASHES``."""
    return max(6, math.ceil(math.log2(max(1, blocks * per_block / BUCKET_HASHES))))


def store(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` as a table bucketed by ``block``, with ``row_id`` naming its rows."""
    spark = docs.sparkSession
    folder = new_folder(spark, "blocks")
    name = "blocks_" + folder.rsplit("-", 1)[-1]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.withColumn("row_id", F.monotonically_increasing_id()).withColumn(
        "block", F.pmod(F.xxhash64("row_id"), F.lit(blocks))
    )
    rows = rows.repartition(width, "block")
    rows.write.option("compression", CODEC).bucketBy(width, "block").sortBy("block").option("path", folder).saveAsTable(name)
    table = spark.table(name)
    # The catalog forgets the table at once; its files stay, and the plan keeps their layout.
    spark.sql(f"DROP TABLE {name}")
    return table


def other_columns(docs: DataFrame, *own: str) -> Column:
    """A struct of the columns of ``docs`` but ``own``, so that names cannot clash."""
    names = {c.lower() for c in own}
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names]
    return F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("none"))


def keep(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back: no later job makes them again."""
    path = new_folder(rows.sparkSession, name)
    rows.write.option("compression", CODEC).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results were kept.

    Spark does so once the driver's garbage collector has found that no plan needs them; a
    driver with little garbage comes to that late, and files of many steps pile up. Nothing
    is lost: later steps start from the written results.
    """
    spark.sparkContext._jvm.System.gc()


def least_hashed(rows: DataFrame, id_col: str, n: int, ties: list[str]) -> list[Row]:
    """The ``n`` rows of least hash of their id, or all if they are fewer; ``ties`` part equal ids.

    An ordered limit would send ``n`` rows of every task to the driver. So rows are written,
    and only those below a bound are ordered: one that about ``n`` and a quarter more are
    expected to pass, and a higher one should they be too few.
    """
    hashed = keep(rows.withColumn("_hash", F.xxhash64(id_col)), "hashed")
    share = 1.25 * n / max(1, hashed.count())
    while True:
        some = hashed
        if share < 1:
            some = hashed.where(F.col("_hash") <= int((share - 0.5) * 2.0**64))
        if share >= 1 or some.count() >= n:
            return some.orderBy("_hash", id_col, *ties).limit(n).collect()
        share *= 2


def planes(values: np.ndarray) -> bytes:
    """Bytes of integers, all first bytes first: high zero bytes then compress to nothing."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(raw: bytes, n: int, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(raw, dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(flat.T).view(dtype).reshape(n)


def bucket_edges(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes."""
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    inner = np.searchsorted(hashes, bounds)
    return np.concatenate([[0], inner, [len(hashes)]])


def question(
    block: int,
    level: int,
    bits: int,
    hashes: np.ndarray,
    more: Callable[[int, int], bytes],
    send: bool = True,
) -> pa.Table:
    """Rows of ``ASKED`` for sorted hashes; ``more(lo, hi)`` packs what goes with a part.

    Without ``send`` the hashes only choose the bucket.
    """
    edges = bucket_edges(hashes, bits)
    full = [b for b in range(1 << bits) if edges[b] < edges[b + 1]]
    return pa.table(
        {
            "block": pa.array([block] * len(full), pa.int64()),
            "level": pa.array([level] * len(full), pa.int32()),
            "bucket": pa.array(full, pa.int32()),
            "n": pa.array([int(edges[b + 1] - edges[b]) for b in full], pa.int32()),
            "hashes": pa.array(
                [hashes[edges[b] : edges[b + 1]].tobytes() if send else b"" for b in full],
                pa.binary(),
            ),
            "more": pa.array([more(int(edges[b]), int(edges[b + 1])) for b in full], pa.binary()),
        }
    )


def answer(asked: DataFrame, judge: Callable[[list[dict]], list[bytes]]) -> DataFrame:
    """One row of ``ANSWERED`` for each row of ``ASKED``; ``judge`` sees one whole bucket."""

    def of_bucket(table: pa.Table) -> pa.Table:
        said = judge(table.select(["level", "n", "hashes", "more"]).to_pylist())
        return pa.table(
            {
                "block": table["block"],
                "level": table["level"],
                "bucket": table["bucket"],
                "bits": pa.array(said, pa.binary()),
            }
        )

    return asked.groupBy("level", "bucket").applyInArrow(of_bucket, ANSWERED)


def repeated(rows: list[dict]) -> list[bytes]:
    """For every asked hash: do other blocks ask for it too, or does one hold it twice?

    ``more`` has a bit for each hash, set where its block holds it more than once.
    """
    hashes = np.concatenate([np.frombuffer(r["hashes"], dtype=np.uint64) for r in rows])
    twice = np.concatenate([bits_of(r["more"], r["n"]) for r in rows])
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    group = np.cumsum(fresh) - 1
    several = np.bincount(group) > 1
    several |= np.bincount(group, weights=twice[order]) > 0
    out = np.empty(len(hashes), dtype=bool)
    out[order] = several[group]
    return parts(out, rows)


def earliest(rows: list[dict], owner: list[str]) -> list[bytes]:
    """For every asked hash: does no other block hold it at an earlier place?

    ``more`` has the integers of types ``owner`` as planes: first those that tell apart equal
    hashes, then, from the type marked ``*``, those of the block's earliest place.
    """
    columns = [np.concatenate([np.frombuffer(r["hashes"], dtype=np.uint64) for r in rows])]
    spots = [0] * len(rows)
    for dtype in owner:
        kind = dtype.strip("*")
        found = []
        for i, r in enumerate(rows):
            size = np.dtype(kind).itemsize * r["n"]
            found.append(from_planes(r["more"][spots[i] : spots[i] + size], r["n"], kind))
            spots[i] += size
        columns.append(np.concatenate(found))
    n_keys = 1 + next(i for i, d in enumerate(owner) if d.startswith("*"))
    order = np.lexsort(columns[::-1])
    fresh = changes([c[order] for c in columns[:n_keys]])
    lead = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    first = np.ones(len(order), dtype=bool)
    for c in columns[n_keys:]:
        first &= c[order] == c[lead]
    out = np.empty(len(order), dtype=bool)
    out[order] = first
    return parts(out, rows)


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return fresh


def parts(flags: np.ndarray, rows: list[dict]) -> list[bytes]:
    edges = np.cumsum([0, *(r["n"] for r in rows)])
    return [np.packbits(flags[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])]


def bits_of(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=n).astype(bool)


def read_answer(replies: pa.Table, level: int, bits: int, hashes: np.ndarray) -> np.ndarray:
    """The answers of one level, in the order of the block's sorted ``hashes``."""
    out = np.zeros(len(hashes), dtype=bool)
    edges = bucket_edges(hashes, bits)
    for row in replies.select(["level", "bucket", "bits"]).to_pylist():
        if row["level"] == level:
            a, b = edges[row["bucket"]], edges[row["bucket"] + 1]
            out[a:b] = bits_of(row["bits"], int(b - a))
    return out
