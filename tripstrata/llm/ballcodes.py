"""Product codes of vectors by exact ball k-means.

Components become whole numbers, ``floor(1024 * x)``; vectors are cut into equal parts, and
each part has a codebook, started from the vectors of the smallest ids. A round assigns every
part to its nearest entry and moves each entry to the floor of its parts' mean.

An entry with the parts that the round before gave it is a ball. Its radius, the largest
distance of such a part from the moved entry, defines the neighbours: only an entry within
twice the radius can take a part over. A part nearer than half the way to the nearest
neighbour lies in the stable core and is not looked at again. The others lie in rings between
half the distances to one neighbour and the next, and are compared with the neighbours up to
their ring only. All is done in whole numbers, and neighbours at exactly twice the distance
are compared, so that the result is that of a full search, ties included.

The first round searches all entries. Each round is one pass over the table that the round
before wrote, rows with their codes; a task sums up its parts by entry, and the sums, whose
number does not grow with the input, are added in Spark. Nothing else reaches the driver but
the first entries: tasks keep their smallest ids, and these are merged over a tree of tasks.

Rows without a vector, or with null or non-finite components, are dropped. Vectors of unequal
length, or of one that the parts do not divide, count as filled up with zeros. Components
beyond a bound that keeps errors within a long (2**16 for 64 components) count as the bound.
Rows of equal ids stay; of these, and with too few of other ids, the lesser vectors are the
first entries. Null ids come last. With fewer rows than entries the codebook is smaller.
Columns other than id, vector and label are left out; their names do not matter. Tables
without usable rows give none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep

#: Vectors that a task works on at once.
CHUNK = 1 << 16
#: Tasks whose smallest ids are merged by one.
FAN_IN = 64
#: Whole numbers below this are exact as doubles.
EXACT = 1 << 53


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows and entries."""
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row, the first of several, and its squared distance."""
    codes, far = np.empty(len(x), np.int64), np.empty(len(x), x.dtype)
    for lo in range(0, len(x), 8192):
        d = _distances(x[lo : lo + 8192], entries)
        best = d.argmin(1)
        codes[lo : lo + 8192], far[lo : lo + 8192] = best, d[np.arange(len(best)), best]
    return codes, far


def nearest_from(
    x: np.ndarray, entries: np.ndarray, before: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, by the balls of the assignment ``before``."""
    codes, far = before.copy(), ((x - entries[before]) ** 2).sum(1)
    between = _distances(entries, entries)
    order = np.argsort(between, axis=1, kind="stable")
    grouped = np.argsort(before, kind="stable")
    edges = np.searchsorted(before[grouped], np.arange(len(entries) + 1))
    for entry in np.flatnonzero(edges[:-1] < edges[1:]):
        rows = grouped[edges[entry] : edges[entry + 1]]
        reach = 4 * far[rows]
        apart = between[entry, order[entry]]
        # Neighbours of the ball, the entry itself and its equals among them.
        near = int(np.searchsorted(apart, reach.max(), side="right"))
        ring = np.searchsorted(apart[:near], reach, side="right")
        outside = ring > 1
        rows, ring = rows[outside], ring[outside]
        # Rings of like width are searched together.
        width = np.ceil(np.log2(np.maximum(ring, 1))).astype(int)
        for w in np.unique(width):
            some = rows[width == w]
            rivals = np.sort(order[entry, : min(near, 1 << w)])
            codes_in, far_in = nearest(x[some], entries[rivals])
            codes[some], far[some] = rivals[codes_in], far_in
    return codes, far


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy().astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _whole_numbers(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int):
    """Usable rows as ``id``, ``label`` and ``v`` of one length, and the largest number."""
    x = F.col(f"`{vec_col}`")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c) == float("inf")))
    rows = vectors.where(x.isNotNull()).where(~odd)
    length = rows.agg(F.max(F.size(x))).first()[0] or 0
    length = max(parts, math.ceil(length / parts) * parts)
    bound = math.isqrt((1 << 60) // length) // 2
    number = lambda c: F.greatest(
        F.lit(-bound), F.least(F.lit(bound), F.floor(c.cast("double") * 1024))
    ).cast("int")
    filled = F.concat(F.transform(x, number), F.array_repeat(F.lit(0), F.lit(length) - F.size(x)))
    return rows.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").alias("label"),
        filled.alias("v"),
    ), length


def _least(rows: DataFrame, n: int) -> list[list[int]]:
    """Vectors of the ``n`` smallest ids; each task of a tree hands on its own ``n`` at most."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for batch in batches:
            ids = batch.column(0)
            # All rows that could be among the first n, whatever their ties.
            if batch.num_rows > n:
                last = ids.take(pc.select_k_unstable(ids, n, [("", "ascending")]))[-1]
                if last.is_valid:
                    batch = batch.filter(pc.less_equal(ids, last))
            found = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            best += [(i is None, i or 0, v) for i, v in found]
            best = sorted(best)[:n]
        if best:
            ids = pa.array([None if null else i for null, i, _ in best], pa.int64())
            vs = pa.array([v for *_, v in best], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, vs], ["id", "v"])

    schema = "id long, v array<int>"
    found = rows.select("id", "v")
    tasks = found.rdd.getNumPartitions()
    while True:
        found = found.mapInArrow(top, schema)
        if tasks <= 1:
            break
        tasks = math.ceil(tasks / FAN_IN)
        found = found.repartition(tasks)
    first = [(r.id is None, r.id or 0, list(r.v)) for r in found.collect()]
    return [v for *_, v in sorted(first)[:n]]


def _rows(columns: dict, n: int, label: pa.DataType, last: bool) -> list[pa.RecordBatch]:
    """Batches of a round's result; columns that are not given are null."""
    kinds = {"id": pa.int64(), "label": label}
    if last:
        kinds |= {"codes": pa.list_(pa.int32()), "error": pa.int64()}
    else:
        numbers = {"v": pa.list_(pa.int32()), "codes": pa.list_(pa.int32())}
        kinds |= numbers | {"entry": pa.int32(), "n": pa.int64(), "total": pa.list_(pa.int64())}
    given = [columns[c].cast(k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()]
    return pa.table(given, names=list(kinds)).to_batches()


def _round(rows: DataFrame, books: list[np.ndarray], last: bool) -> DataFrame:
    """Rows with the codes that ``books`` give them; in the end, their errors.

    Before the end the result also has, for each task, the number and the sum of the parts of
    each entry: ``entry`` counts the entries of all parts, ``n`` is null in a row.
    """
    parts, (size, w) = len(books), books[0].shape
    top = max(int(np.abs(b).max()) for b in books)
    started = "codes" in rows.columns
    kind = rows.schema["label"].dataType.simpleString()
    names = "id long, label " + kind
    if last:
        schema = f"{names}, codes array<int>, error long"
    else:
        schema = f"{names}, v array<int>, codes array<int>, entry int, n long, total array<long>"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, size), np.int64)
        total = np.zeros((parts, size, w), np.int64)
        label = None
        for table in _tables(batches):
            label = table["label"].type
            whole = _matrix(table["v"], np.int64)
            most = max(top, int(np.abs(whole).max()))
            # Doubles multiply faster, and are exact while four times a distance is.
            dtype = np.float64 if 16 * w * most * most < EXACT else np.int64
            before = _matrix(table["codes"], np.int64) if started else None
            codes = np.empty((len(whole), parts), np.int32)
            error = np.zeros(len(whole), np.int64)
            for p, book in enumerate(books):
                numbers = whole[:, p * w : (p + 1) * w]
                x, entries = numbers.astype(dtype), book.astype(dtype)
                found, far = nearest(x, entries) if before is None else nearest_from(x, entries, before[:, p])
                codes[:, p] = found
                error += far.astype(np.int64)
                if not last:
                    order = np.argsort(found, kind="stable")
                    used, at = np.unique(found[order], return_index=True)
                    total[p, used] += np.add.reduceat(numbers[order], at, axis=0)
                    count[p] += np.bincount(found, minlength=size)
            spots = np.arange(0, codes.size + 1, parts, dtype=np.int32)
            coded = pa.ListArray.from_arrays(pa.array(spots), pa.array(codes.reshape(-1)))
            columns = {"id": table["id"], "label": table["label"], "codes": coded}
            columns |= {"error": pa.array(error)} if last else {"v": table["v"]}
            yield from _rows(columns, len(whole), label, last)
        if label is not None and not last:
            used = np.flatnonzero(count.reshape(-1))
            columns = {
                "entry": pa.array(used, pa.int32()),
                "n": pa.array(count.reshape(-1)[used]),
                "total": pa.array(total.reshape(-1, w)[used].tolist(), pa.list_(pa.int64())),
            }
            yield from _rows(columns, len(used), label, last)

    return keep(rows.mapInArrow(assign, schema), "codes")


def _moved(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Entries at the floors of their parts' means; entries without parts stay."""
    wide = "decimal(38,0)"
    sums = (
        state.where("n is not null")
        .select("entry", "n", F.posexplode("total").alias("place", "part_sum"))
        .groupBy("entry", "place")
        .agg(F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("part_sum").cast(wide)).alias("total"))
    )
    out = [book.copy() for book in books]
    size = len(books[0])
    # One row for each component of each entry.
    for r in sums.collect():
        out[r.entry // size][r.entry % size, r.place] = int(r.total) // int(r.n)
    return out


def vector_codes(
    vectors: DataFrame,
    entries: int = 256,
    parts: int = 4,
    rounds: int = 4,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """``id``, ``label``, ``codes`` and ``error`` of every usable row, and the codebooks."""
    rows, length = _whole_numbers(vectors, id_col, vec_col, label_col, parts)
    first = np.array(_least(rows, entries), dtype=np.int64).reshape(-1, length)
    w = length // parts
    books = [first[:, p * w : (p + 1) * w].copy() for p in range(parts)]
    if not len(first):
        none = rows.select("id", "label", F.array().cast("array<int>").alias("codes"))
        return none.withColumn("error", F.lit(0).cast("long")), books
    state = rows
    for _ in range(rounds):
        state = _round(state, books, last=False)
        books = _moved(state, books)
        state = state.where("n is null").select("id", "label", "v", "codes")
    return _round(state, books, last=True), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of a label in sum; rows without a label count as one label.

    The sums are written before the join, so that Spark knows their size: it broadcasts a few
    and, with many, splits a label that holds a large share of the rows.
    """
    sums = keep(
        coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")),
        "label-errors",
    )
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")


def code_text(codes: Column) -> Column:
    """Two lower-case hex digits for each part."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def books_digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(n) for book in books for entry in book.tolist() for n in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()
