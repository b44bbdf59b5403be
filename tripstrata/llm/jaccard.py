"""Exact similarity join of shingle sets by slice signatures, with pivots to save comparisons.

A join in the metric space of the Jaccard distance, by Voronoi cells around pivots and windows
that replicate documents at the cells' boundaries, was replaced: distances of unrelated texts
all lie near 1, so the windows of pivots drawn from the corpus reach every cell and each
document would be replicated to nearly all. No document is assigned to its nearest pivot here,
and none is replicated by distance. Instead:

* Candidates come from slices alone: sets of close size are cut into more slices by hash than
  the elements that linked sets can differ by, so linked sets agree in some slice. This loses
  no link.
* The least document of a slice is its pivot. Sketches, counts of hashes by their first bits,
  rule out pivots that a document cannot link with; they lose no link either, as counts differ
  by no more than the sets do. A document is then compared with the least of the pivots left,
  and after that with those of other components, exactly. In a slice whose documents are not
  all connected by that, sketches name those that may link across components, and these are
  joined pair by pair from pivot to pivot; the triangle inequality serves only to cut such a
  region where distances to a pivot leave a gap wider than the radius.

Pairs within one component are not compared, as a link between them joins nothing new.
Sets that are equal are one node. Only hashes that several documents share travel; pairs are
never written out within a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripstrata.llm import blocks as B
from tripstrata.llm import grams as G
from tripstrata.llm.components import components

SHINGLE = 3
#: Similarity at which documents link, in hundredths.
PERCENT = 90
#: Documents of a region that one task compares; larger regions are cut into pairs of parts.
REGION = 2000
#: Slices beyond the least number, in hundredths of it, so that empty ones need not be sent.
SPARE = 12
#: Blocks that a set is sent to out of its own block.
FEW = 16
#: Hashes of a set for each count of its sketch, and the bits of the smallest sketch.
_PER_PATTERN, _LEAST_BITS, _MOST = 4, 4, 255
_PER_BLOCK = 120_000
_SLICES = 1


class _Sets:
    """Distinct shingle hashes of every text, one sorted array after the other."""

    def __init__(self, table: pa.Table, shingle: int) -> None:
        whole = G.texts(table["text"])
        self.texts = G.Texts(G.LOWER_ASCII[whole.data], whole.offsets)
        words = G.words(self.texts)
        hashes = G.word_hashes(self.texts, words)
        counts = np.diff(words.first)
        grams = G.mix(G.chain(hashes, shingle))
        owner = words.text[: len(grams)]
        inside = G.same_text(words.text, shingle)
        short = np.flatnonzero((counts > 0) & (counts < shingle))
        tail = [
            G.mix(G.chain(hashes[words.first[i] : words.first[i + 1]], int(counts[i])) + np.uint64(7))
            for i in short
        ]
        values = np.concatenate([grams[inside], *tail])
        owner = np.concatenate([owner[inside], short])
        order = np.lexsort([values, owner])
        values, owner = values[order], owner[order]
        fresh = B.changes([owner, values])
        self.values, self.owner = values[fresh], owner[fresh]
        self.first = np.searchsorted(self.owner, np.arange(len(self.texts) + 1))
        self.size = np.diff(self.first)

    def values_of(self, i: int) -> np.ndarray:
        return self.values[self.first[i] : self.first[i + 1]]

    def of(self, i: int) -> bytes:
        return self.values_of(i).tobytes()

    def prints(self) -> list[np.ndarray]:
        """Two hashes of every set."""
        out = []
        for salt in (1, 2):
            total = np.zeros(len(self.values) + 1, dtype=np.uint64)
            np.cumsum(G.mix(self.values + np.uint64(salt)), out=total[1:])
            sums = total[self.first[1:]] - total[self.first[:-1]]
            out.append(G.mix(sums + self.size.astype(np.uint64)).view(np.int64))
        return out


    def sketches(self) -> list[bytes]:
        """How many hashes of every set begin with each pattern of bits, as bytes.

        Four hashes share a pattern, or fewer; larger counts than a byte holds are cut.
        """
        few = np.maximum(self.size, 1) / _PER_PATTERN
        bits = np.maximum(_LEAST_BITS, np.ceil(np.log2(few))).astype(np.int64)
        ends = np.cumsum(1 << bits)
        begin = ends - (1 << bits)
        shift = (64 - bits[self.owner]).astype(np.uint64)
        place = begin[self.owner] + (self.values >> shift).astype(np.int64)
        total = int(ends[-1]) if len(ends) else 0
        counts = np.minimum(np.bincount(place, minlength=total), _MOST).astype(np.uint8)
        return [counts[a:b].tobytes() for a, b in zip(begin, ends)]


def size_classes(most: int, percent: int) -> np.ndarray:
    """Ends of size ranges so wide that linked sets stand in one or in neighbouring ranges."""
    ends = [1]
    while ends[-1] < most:
        ends.append(max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))
    return np.array(ends)


def slack(size: np.ndarray, percent: int) -> np.ndarray:
    """The most elements that differ between linked sets of at most ``size`` elements."""
    return 2 * size * (100 - percent) // (100 + percent)


def slice_prints(sets: _Sets, rows: np.ndarray, percent: int):
    """Hashes of all slices of the sets ``rows``, with the row of each."""
    size = sets.size[rows]
    if not len(rows):
        return np.zeros(0, dtype=np.uint64), rows
    ends = size_classes(int(size.max()) + 1, percent)
    ends = np.append(ends, max(ends[-1] + 1, (ends[-1] + 1) * 100 // percent))
    own = np.searchsorted(ends, size)
    value_rows = np.repeat(np.arange(len(rows)), size)
    spots = np.repeat(sets.first[rows], size) + (
        np.arange(len(value_rows)) - np.repeat(np.cumsum(size) - size, size)
    )
    values = sets.values[spots]
    hashes, owners = [], []
    for step in (0, 1):
        kind = own + step
        most = slack(ends[kind], percent)
        width = most + 1 + -(-most * SPARE // 100)
        begin = np.cumsum(width) - width
        place = begin[value_rows] + (values >> np.uint64(32)).astype(np.int64) % width[value_rows]
        sums = np.zeros(int(width.sum()), dtype=np.uint64)
        np.add.at(sums, place, G.mix(values))
        which = np.repeat(np.arange(len(rows)), width)
        # Linked sets agree in at least width - most slices. A set with fewer empty ones than
        # that agrees in a full one; a set with more has them in common with its partner.
        full = np.bincount(place, minlength=len(sums)) > 0
        empty = np.bincount(which, weights=~full, minlength=len(rows))
        sent = full | (empty >= width - most)[which]
        number = np.arange(len(which)) - begin[which]
        label = (ends[kind][which].astype(np.uint64) << np.uint64(24)) + number.astype(np.uint64)
        hashes.append(G.mix(sums + G.mix(label))[sent])
        owners.append(rows[which][sent])
    return np.concatenate(hashes), np.concatenate(owners)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = common(a, b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Shared elements of two sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def join_region(sets: list[np.ndarray], group: list[int], percent: int):
    """Links that connect all groups which any link connects, as pairs of places."""
    parent = {g: g for g in group}

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    radius = 1 - percent / 100 + 1e-9
    rest, found = list(range(len(sets))), []
    while rest:
        # The next pivot: every document it can link with is compared or ruled out.
        pivot, rest = rest[0], rest[1:]
        size, away = len(sets[pivot]), {}
        for i in rest:
            n = len(sets[i])
            if min(n, size) * 100 < percent * max(n, size) or root(group[i]) == root(group[pivot]):
                continue
            shared = common(sets[pivot], sets[i])
            away[i] = 1 - shared / (n + size - shared)
            if 100 * shared >= percent * (n + size - shared):
                parent[root(group[i])] = root(group[pivot])
                found.append((pivot, i))
        # Documents whose distances to the pivot differ by more than the radius cannot link;
        # where no window reaches across, the cells are joined apart.
        near = sorted(away, key=away.__getitem__)
        cuts = [k for k in range(1, len(near)) if away[near[k]] - away[near[k - 1]] > radius]
        if cuts and len(near) == len(rest):
            for a, b in zip([0, *cuts], [*cuts, len(near)]):
                cell = near[a:b]
                sub = join_region(
                    [sets[i] for i in cell],
                    [root(group[i]) for i in cell],
                    percent,
                )
                found += [(cell[i], cell[j]) for i, j in sub]
            return found
        if len({root(group[i]) for i in rest}) < 2:
            return found
    return found


def _named(left: pa.Table, right: pa.Table, name: str) -> pa.Table:
    """The rows of a block that ``right`` names."""
    return left.filter(pa.array(np.isin(left["row_id"].to_numpy(), right[name].to_numpy())))


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch, or rows of them, with the counts of fewer leading bits."""
    while sketch.shape[-1] > size:
        sketch = np.minimum(sketch[..., ::2] + sketch[..., 1::2], _MOST)
    return sketch


def may_link(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Can sets of ``n_a`` and ``n_b`` elements with these sketches link?

    Counts differ by no more than the elements that only one set has. Of linked sets these are
    at most ``100 - percent`` for each ``100 + percent`` elements of both.
    """
    least = min(len(a), len(b))
    apart = np.abs(_folded(a.astype(np.int32), least) - _folded(b.astype(np.int32), least)).sum()
    return int(apart) * (100 + percent) <= (n_a + n_b) * (100 - percent)


def partners(sketches: list[np.ndarray], sizes: np.ndarray, group: np.ndarray, percent: int) -> np.ndarray:
    """Which sets may link with one of another group, by their sketches."""
    found = np.zeros(len(sketches), dtype=bool)
    widths = np.array([len(x) for x in sketches], dtype=np.int64)
    for width in np.unique(widths):
        # Sets of one width against those of the same and of larger ones.
        rows = np.flatnonzero(widths >= width)
        rows = rows[np.argsort(sizes[rows], kind="stable")]
        # Linked sets differ less in size than by this, so no wider one is looked at.
        rows = rows[: np.searchsorted(sizes[rows] * percent, 100 * sizes[widths == width].max(), "right")]
        counts = np.stack([_folded(sketches[i].astype(np.int16), width) for i in rows])
        n, own = sizes[rows], group[rows]
        for at in np.flatnonzero(widths[rows] == width):
            lo = np.searchsorted(n * 100, n[at] * percent)
            hi = np.searchsorted(n * percent, n[at] * 100, "right")
            others = lo + np.flatnonzero(own[lo:hi] != own[at])
            apart = np.abs(counts[others] - counts[at]).sum(axis=1)
            near = others[apart * (100 + percent) <= (n[others] + n[at]) * (100 - percent)]
            found[rows[near]] = True
            found[rows[at]] |= len(near) > 0
    return found


def _sets_of(by_block, rows: DataFrame, shingle: int) -> DataFrame:
    """``row_id`` and ``items``, its sorted hashes, for ``rows`` of row id and block."""

    def sets(left: pa.Table, right: pa.Table) -> pa.Table:
        some = _named(left, right, "row_id")
        found = _Sets(some, shingle)
        items = pa.array([found.of(i) for i in range(some.num_rows)], pa.binary())
        return pa.table({"row_id": some["row_id"], "items": items})

    made = by_block.cogroup(rows.groupBy("block")).applyInArrow(sets, "row_id long, items binary")
    return B.keep(made, "sets")


def _verified_at_home(
    pairs: DataFrame, by_block, where: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets link, for pairs with one ``b`` for each ``a``.

    The set of a ``b`` goes once to each block that has an ``a`` of it; sets of ``a`` are made
    where their texts lie and go nowhere. A block gets no more sets than it has texts. A set
    that few blocks want leaves its own block as often as it is wanted; one that many want,
    which a block could not hold so often, is written once and joined with them.
    """
    at = where.select(F.col("row_id").alias("a"), "block")
    homes = B.keep(pairs.join(at, "a"), "homes")
    wanted = homes.select("b", F.col("block").alias("to")).distinct()
    wanted = B.keep(wanted.join(wanted.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b"), "wanted")
    few = wanted.where(F.col("n") <= FEW).join(where.withColumnRenamed("row_id", "b"), "b")

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        some = _named(left, right, "b")
        found = _Sets(some, shingle)
        place = {row: i for i, row in enumerate(some["row_id"].to_pylist())}
        items = [found.of(place[b]) for b in right["b"].to_pylist()]
        return pa.table({"block": right["to"], "b": right["b"], "items": pa.array(items, pa.binary())})

    routes = few.select("block", "b", "to").groupBy("block")
    sent = by_block.cogroup(routes).applyInArrow(send, "block long, b long, items binary")
    many = wanted.where(F.col("n") > FEW).select("b", F.col("to").alias("block"))
    ends = many.select(F.col("b").alias("row_id")).distinct().join(where, "row_id")
    often = many.join(_sets_of(by_block, ends, shingle).withColumnRenamed("row_id", "b"), "b")
    asked = homes.unionByName(sent, True).unionByName(often, True).groupBy("block")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        asked = right.filter(pc.is_valid(right["a"]))
        some = _named(left, asked, "a")
        found = _Sets(some, shingle)
        place = {row: i for i, row in enumerate(some["row_id"].to_pylist())}
        told = right.filter(pc.is_valid(right["items"]))
        items = dict(zip(told["b"].to_pylist(), told["items"].to_pylist()))
        ends = [(a, b) for a, b in zip(asked["a"].to_pylist(), asked["b"].to_pylist())]
        links = [
            (a, b)
            for a, b in ends
            if linked(found.values_of(place[a]), np.frombuffer(items[b], np.uint64), percent)
        ]
        return pa.table(
            {
                "a": pa.array([a for a, _ in links], pa.int64()),
                "b": pa.array([b for _, b in links], pa.int64()),
            }
        )

    return by_block.cogroup(asked).applyInArrow(check, "a long, b long")


def _both_ends(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` with the columns that ``of`` has for the rows at both ends."""
    for x in "ab":
        named = [F.col(c).alias(f"{x}_{c}") for c in of.columns if c != "row_id"]
        pairs = pairs.join(of.select(F.col("row_id").alias(x), *named), x)
    return pairs


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets link."""

    def check(batches):
        for batch in batches:
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch["a_items"].to_pylist(), batch["b_items"].to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _both_ends(pairs, sets).mapInArrow(check, "a long, b long")


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that may link by their sketches; loses no link."""

    def check(batches):
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("a_sketch", "b_sketch", "a_n", "b_n"))
            keep = [
                may_link(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), n, m, percent)
                for x, y, n, m in zip(*columns)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _both_ends(pairs, sketches).mapInArrow(check, "a long, b long")


def _with_parts(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs with the components of both ends; a node without links is its own."""
    for x in "ab":
        other = parts.select(F.col("node").alias(x), F.col("component").alias(f"{x}_part"))
        pairs = pairs.join(other, x, "left")
    return pairs.select(
        "a", "b", *(F.coalesce(f"{x}_part", x).alias(f"{x}_part") for x in "ab")
    )


def similarity_components(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """The group of linked documents that each belongs to.

    A document's set holds its distinct runs of ``shingle`` words, A-Z in lower case; a shorter
    text's whole word sequence is its one element. Documents link when the shared part of
    their sets is at least ``percent`` hundredths of the union. Texts without words, and nulls,
    have empty sets and link with nothing.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (the least id reachable by links; null
    ids count only where a group has no other) and ``keeper``, true for one row of each group,
    the first of those with the least id; with ``carry`` also ``text`` and ``rest``, a struct of
    the other columns of ``docs``. Every row of ``docs`` gives one row.
    """
    rest = B.other_columns(docs, id_col, text_col) if carry else F.lit(None).cast("string")
    blocks = B.n_blocks(docs, text_col)
    bits = B.bucket_bits(blocks, _PER_BLOCK)
    stored = B.store(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(text_col).alias("text"),
            rest.alias("rest"),
        ),
        blocks,
    )
    by_block = stored.select("block", "row_id", "text").groupBy("block")

    def prints(left: pa.Table) -> pa.Table:
        sets = _Sets(left, shingle)
        one, two = sets.prints()
        names = ["block", "row_id"]
        return pa.table([left[n] for n in names], names=names).append_column(
            "n_shingles", pa.array(sets.size, pa.int64())
        ).append_column("one", pa.array(one)).append_column("two", pa.array(two)).append_column(
            "sketch", pa.array(sets.sketches(), pa.binary())
        )

    printed = B.keep(
        by_block.applyInArrow(
            prints,
            "block long, row_id long, n_shingles long, one long, two long, sketch binary",
        ),
        "set-prints",
    )
    same = printed.where("n_shingles > 0").groupBy("one", "two", "n_shingles")
    nodes = B.keep(same.agg(F.min_by(F.struct("block", "row_id"), "row_id").alias("lead")), "nodes")
    leads = nodes.select("lead.block", "lead.row_id").groupBy("block")

    def chosen(left: pa.Table, right: pa.Table):
        sets = _Sets(left, shingle)
        ids = left["row_id"].to_numpy()
        rows = np.flatnonzero(np.isin(ids, right["row_id"].to_numpy()) & (sets.size > 0))
        return sets, ids, *slice_prints(sets, rows, percent)

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, hashes, _ = chosen(left, right)
        asked, counts = np.unique(hashes, return_counts=True)
        block = right["block"][0].as_py() if right.num_rows else left["block"][0].as_py()
        return B.question(
            block, _SLICES, bits, asked, lambda a, b: np.packbits(counts[a:b] > 1).tobytes()
        )

    replies = B.keep(
        B.answer(by_block.cogroup(leads).applyInArrow(ask, B.ASKED), B.repeated), "slice-answers"
    )
    marks = leads_and_replies(nodes, replies).groupBy("block")

    def shared(left: pa.Table, right: pa.Table):
        node_rows = right.filter(pc.is_valid(right["row_id"]))
        sets, ids, hashes, rows = chosen(left, node_rows)
        said = right.filter(pc.is_valid(right["bucket"]))
        asked = np.unique(hashes)
        several = B.read_answer(said, _SLICES, bits, asked)[np.searchsorted(asked, hashes)]
        return sets, ids, hashes[several], rows[several]

    def share_slices(left: pa.Table, right: pa.Table) -> pa.Table:
        _, ids, hashes, rows = shared(left, right)
        return pa.table({"slice": pa.array(hashes.view(np.int64)), "row_id": pa.array(ids[rows], pa.int64())})

    both = by_block.cogroup(marks)
    slices = B.keep(both.applyInArrow(share_slices, "slice long, row_id long"), "slices")
    B.release(docs.sparkSession)
    where = nodes.select("lead.row_id", "lead.block")

    sketches = printed.join(where.select("row_id"), "row_id")
    sketches = B.keep(sketches.select("row_id", F.col("n_shingles").alias("n"), "sketch"), "sketches")

    def sets_of(rows: DataFrame) -> DataFrame:
        return _sets_of(by_block, rows.join(where, "row_id"), shingle)

    def ends_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("row_id")).distinct()

    pivots = slices.groupBy("slice").agg(F.min("row_id").alias("pivot"))
    # Not partitioned by slice, so that a slice of many documents can be split.
    spread = pivots.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = slices.join(spread, "slice").where("row_id != pivot")
    cells = B.keep(cells.select(F.col("row_id").alias("a"), F.col("pivot").alias("b")).distinct(), "cells")
    # Most documents that agree in a slice are not alike, and their sketches say so.
    likely = B.keep(_likely(cells, sketches, percent), "likely")
    B.release(docs.sparkSession)
    nearest = likely.groupBy("a").agg(F.min("b").alias("b"))
    links = B.keep(_verified_at_home(nearest, by_block, where, shingle, percent), "links")
    parts = B.keep(components(links), "parts")
    B.release(docs.sparkSession)
    apart = B.keep(_with_parts(likely, parts).where("a_part != b_part").select("a", "b"), "apart")
    links = links.unionByName(B.keep(_verified(apart, sets_of(ends_of(apart)), percent), "links"))
    parts = B.keep(components(links), "parts")
    B.release(docs.sparkSession)
    links = links.unionByName(_regions(cells, parts, sketches, sets_of, percent))
    parts = B.keep(components(links), "parts")
    B.release(docs.sparkSession)

    named = printed.join(
        nodes.select("one", "two", "n_shingles", F.col("lead.row_id").alias("node")),
        ["one", "two", "n_shingles"],
        "left",
    ).join(parts, "node", "left")
    ids = stored.select("row_id", "doc_id")
    named = named.select(
        "block", "row_id", "n_shingles", F.coalesce("component", "node", "row_id").alias("part")
    ).join(ids, "row_id")
    least = named.groupBy("part").agg(
        F.min("doc_id").alias("component_id"),
        F.min_by("row_id", F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")).alias("kept"),
    )
    done = named.join(least, "part").select(
        "block",
        "row_id",
        "doc_id",
        "n_shingles",
        "component_id",
        (F.col("row_id") == F.col("kept")).alias("keeper"),
    )
    if not carry:
        return done.drop("row_id", "block")

    def together(left: pa.Table, right: pa.Table) -> pa.Table:
        at = np.argsort(left["row_id"].to_numpy())
        spots = at[np.searchsorted(left["row_id"].to_numpy()[at], right["row_id"].to_numpy())]
        texts = left.select(["text", "rest"]).take(pa.array(spots))
        return pa.table([*right.select(names).columns, *texts.columns], [*names, "text", "rest"])

    names = ["doc_id", "n_shingles", "component_id", "keeper"]
    schema = StructType(
        [*done.select(*names).schema, stored.schema["text"], stored.schema["rest"]]
    )
    whole = stored.select("block", "row_id", "text", "rest").groupBy("block")
    # The small rows go to the blocks, so that no text is shuffled.
    return whole.cogroup(done.groupBy("block")).applyInArrow(together, schema)


def leads_and_replies(nodes: DataFrame, replies: DataFrame) -> DataFrame:
    """What a block gets back, in one table: its nodes, and its answers."""
    return nodes.select("lead.block", "lead.row_id").unionByName(replies, allowMissingColumns=True)


def _regions(
    cells: DataFrame, parts: DataFrame, sketches: DataFrame, sets_of, percent: int
) -> DataFrame:
    """Links across components within the regions whose documents are not all connected.

    Documents that agree in a slice have cells with one pivot, so a region is the documents of
    a pivot's cells; with the pivot itself they have been compared. Sketches name those that
    may link with one of another component, and only their sets are sent.
    """
    at = _with_parts(cells, parts)
    several = at.groupBy("b").agg(F.min("a_part").alias("lo"), F.max("a_part").alias("hi"))
    mixed = B.keep(several.where("lo != hi").select("b"), "mixed-regions")
    members = at.join(mixed, "b").select(
        F.col("b").alias("pivot"), F.col("a").alias("row_id"), F.col("a_part").alias("part")
    )
    members = B.keep(members, "regions")

    def choose(table: pa.Table) -> pa.Table:
        found = partners(
            [np.frombuffer(x, np.uint8) for x in table["sketch"].to_pylist()],
            table["n"].to_numpy(),
            table["part"].to_numpy(),
            percent,
        )
        return table.select(["pivot", "row_id", "part"]).filter(pa.array(found))

    chosen = _in_parts(members).join(sketches, "row_id").groupBy("pivot", "lo", "hi")
    chosen = chosen.applyInArrow(choose, "pivot long, row_id long, part long").distinct()
    chosen = B.keep(chosen, "likely-members")

    def join(table: pa.Table) -> pa.Table:
        rows = table.select(["row_id", "part"]).to_pylist()
        order = sorted(range(len(rows)), key=lambda i: rows[i]["row_id"])
        items = table["items"].to_pylist()
        values = [np.frombuffer(items[i], np.uint64) for i in order]
        pairs = join_region(values, [rows[i]["part"] for i in order], percent)
        ids = [rows[i]["row_id"] for i in order]
        return pa.table(
            {
                "a": pa.array([ids[i] for i, _ in pairs], pa.int64()),
                "b": pa.array([ids[j] for _, j in pairs], pa.int64()),
            }
        )

    sets = sets_of(chosen.select("row_id").distinct())
    found = _in_parts(chosen).join(sets, "row_id").groupBy("pivot", "lo", "hi")
    return B.keep(found.applyInArrow(join, "a long, b long"), "links")


def _in_parts(members: DataFrame) -> DataFrame:
    """Regions of over ``REGION`` documents as pairs ``lo``, ``hi`` of parts of that size."""
    sizes = members.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / REGION).alias("n_parts"))
    spread = members.join(sizes, "pivot").withColumn(
        "mine", F.pmod(F.xxhash64("row_id"), F.col("n_parts"))
    )
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
    return spread.select(
        "pivot",
        F.least("mine", "other").alias("lo"),
        F.greatest("mine", "other").alias("hi"),
        "row_id",
        "part",
    )
