"""Quality scores by gradient-boosted trees over document statistics.

The statistics of all texts are worked out in one pass, as numpy arrays over whole batches,
and kept. Trees are learned on the driver from a sample of labelled rows of bounded size, by
histograms of binned statistics; they are flattened into arrays, and all rows of a batch go
down all trees at once.

A null or empty text has all statistics zero and is scored as such. Labels are ignored where
they are null; of several for one document the mean decides. Without labels of both kinds
every score is the share of label 1, or one half. Tables without rows give none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import blocks as B
from tripstrata.llm import grams as G

#: Most labelled rows learned from; those of least hash of their id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAF_ROWS = 60, 4, 64, 0.15, 20

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>",
    "mark": b".,;:?",
    "shout": b"!",
    "space": b" \t\n\r\x0b\x0c",
    "at": b"@_=/\\{}[]()",
    "wide": bytes(range(0xC0, 0x100)),
}
FEATURES = [
    "log_bytes",
    *_CLASSES,
    "log_words",
    "word_bytes",
    "distinct_words",
    "top_word",
    "repeated_windows",
    "lines_per_word",
    "repeated_lines",
    "symbol_words",
    "upper_words",
    "stops",
]


def _runs(owner: np.ndarray, values: np.ndarray, n: int):
    """Per owner: values, distinct values, most copies of one, and values that repeat."""
    order = np.lexsort([values, owner])
    o, v = owner[order], values[order]
    first = np.flatnonzero(B.changes([o, v]))
    sizes = np.diff(np.append(first, len(o)))
    total, distinct = np.bincount(o, minlength=n), np.bincount(o[first], minlength=n)
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, o[first], sizes)
    again = np.bincount(o[first], weights=np.where(sizes > 1, sizes, 0), minlength=n)
    return total, distinct, most, again


def statistics(part: G.Texts) -> np.ndarray:
    """A row of ``FEATURES`` for every text."""
    n = len(part)
    size = np.diff(part.offsets)
    columns = [np.log1p(size)]
    share = lambda a, b: np.asarray(a, dtype=float) / np.maximum(b, 1)
    masks = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, dtype=bool)
        table[list(members)] = True
        masks[name] = table[part.data]
        total = np.concatenate([[0], np.cumsum(masks[name])])
        columns.append(share(total[part.offsets[1:]] - total[part.offsets[:-1]], size))
    words = G.words(part)
    codes = G.prefix_codes(part.data)
    hashes = G.span_hashes(codes, words.start, words.end)
    count, distinct, most, _ = _runs(words.text, hashes, n)
    length = np.bincount(words.text, weights=words.end - words.start, minlength=n)
    columns += [np.log1p(count), share(length, count), share(distinct, count), share(most, count)]
    same = G.same_text(words.text, 5)
    windows, _, _, again = _runs(words.text[: len(same)][same], G.chain(hashes, 5)[same], n)
    columns.append(share(again, windows))
    breaks = np.flatnonzero(part.data == 10)
    starts = np.unique(np.concatenate([part.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(part.data)]
    ends = np.minimum(np.append(starts[1:], len(part.data)), len(part.data))
    owner = np.searchsorted(part.offsets, starts, side="right") - 1
    lines, _, _, line_again = _runs(owner, G.span_hashes(codes, starts, ends), n)
    columns += [share(lines, count), share(line_again, lines)]
    for name in ("symbol", "upper", "mark"):
        last = masks[name][words.end - 1] if name != "upper" else masks[name][words.start] & masks[name][words.end - 1]
        columns.append(share(np.bincount(words.text, weights=last, minlength=n), count))
    return np.column_stack(columns).astype(np.float32)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_id``, ``doc_id`` and ``stats``, a float32 row of ``FEATURES`` as bytes."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = [statistics(part) for _, part in G.slices(G.texts(batch["text"]))]
            raw = [row.tobytes() for rows in found for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch["row_id"], batch["doc_id"], pa.array(raw, pa.binary())],
                ["row_id", "doc_id", "stats"],
            )

    return rows.mapInArrow(run, "row_id long, doc_id long, stats binary")


@dataclass
class Trees:
    """All trees in flat arrays; children of node ``i`` are ``child[i]`` and the one after."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        node = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            child = self.child[node]
            right = x[rows, self.feature[node]] > self.cut[node]
            node = np.where(child >= 0, child + right, node)
        total = self.base + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def learn(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Trees of Newton steps on the logistic loss."""
    rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) and 0 < y.sum() < len(y) else None
    share = float(np.clip(y.mean() if len(y) else 0.5, 0, 1))
    base = float(np.log(rate / (1 - rate))) if rate else float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    nodes: dict[str, list] = {"feature": [], "cut": [], "child": [], "value": []}

    def add() -> int:
        for name, blank in (("feature", 0), ("cut", 0.0), ("child", -1), ("value", 0.0)):
            nodes[name].append(blank)
        return len(nodes["cut"]) - 1

    roots: list[int] = []
    if rate:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        bins = np.column_stack([np.searchsorted(q, c) for q, c in zip(cuts, x.T)])
        flat = bins + np.arange(x.shape[1]) * BINS
        total = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-total))
            gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
            roots.append(add())
            level = [(roots[-1], np.arange(len(y)))]
            for d in range(depth + 1):
                following = []
                for node, rows in level:
                    split = _best_split(flat[rows], gradient[rows], weight[rows], x.shape[1]) if d < depth else None
                    if split is None:
                        step = -RATE * gradient[rows].sum() / (weight[rows].sum() + 1)
                        nodes["value"][node] = step
                        total[rows] += step
                        continue
                    feature, at = split
                    right = bins[rows, feature] > at
                    nodes["feature"][node], nodes["cut"][node] = feature, float(cuts[feature][at])
                    nodes["child"][node] = add()
                    add()
                    for i, side in enumerate((~right, right)):
                        following.append((nodes["child"][node] + i, rows[side]))
                level = following
    kinds = {"feature": np.int32, "cut": np.float32, "child": np.int32, "value": np.float64}
    arrays = {k: np.array(v, dtype=kinds[k]) for k, v in nodes.items()}
    return Trees(np.array(roots, dtype=np.int32), **arrays, base=base, depth=depth)


def _best_split(flat, gradient, weight, n_features):
    """Feature and last bin of the left side, or None where no split helps."""
    size = n_features * BINS
    sums = [
        np.bincount(flat.ravel(), np.repeat(w, n_features), size).reshape(n_features, BINS).cumsum(1)
        for w in (gradient, weight, np.ones(len(gradient)))
    ]
    g, h, n = sums
    gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
    gain[(n < LEAF_ROWS) | (n[:, -1:] - n < LEAF_ROWS)] = 0
    best = int(gain.argmax())
    return divmod(best, BINS) if gain.flat[best] > 1e-3 else None


def is_held_out(id_col: str):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    ``labels`` has ``doc_id`` and ``quality``. With ``carry`` also ``rest``, a struct of all
    columns of ``docs``.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stats = B.keep(with_statistics(plain).drop("row_id"), "statistics")
    marks = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg((F.avg("quality") >= 0.5).cast("double").alias("quality"))
    sample = stats.join(marks, "doc_id").where(~is_held_out("doc_id"))
    rows = B.least_hashed(sample.select("doc_id", "stats", "quality"), "doc_id", sample_rows, ["stats"])
    x = np.array([np.frombuffer(r.stats, np.float32) for r in rows]).reshape(-1, len(FEATURES))
    trees = learn(x, np.array([r.quality for r in rows]))

    def score(batches):
        for batch in batches:
            raw = batch["stats"].to_pylist()
            x = np.frombuffer(b"".join(raw), np.float32).reshape(-1, len(FEATURES))
            found = trees.scores(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(found, pa.float64())], [*names, "score"]
            )

    if carry:
        # Read, measured and scored in one pass, so that no text is shuffled; the text is
        # taken from the struct, so that a batch holds it once.
        both = docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("rest"),
        )
        place = [c.lower() for c in docs.columns].index(text_col.lower())

        def measure_and_score(batches):
            for batch in batches:
                column = pc.struct_field(batch["rest"], [place])
                found = [statistics(part) for _, part in G.slices(G.texts(column))]
                scores = [trees.scores(x) for x in found] or [np.zeros(0)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["rest"], pa.array(np.concatenate(scores), pa.float64())],
                    ["doc_id", "rest", "score"],
                )

        kind = both.schema["rest"].dataType.simpleString()
        done = both.mapInArrow(measure_and_score, f"doc_id long, rest {kind}, score double")
    else:
        names = ["doc_id"]
        done = stats.mapInArrow(score, "doc_id long, score double")
    return done.withColumns(
        {"held_out": is_held_out("doc_id"), "predicted": (F.col("score") >= 0.5).cast("int")}
    ).select("doc_id", "held_out", "score", "predicted", *(["rest"] if carry else []))
