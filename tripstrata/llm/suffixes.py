"""Byte strings that also start in a text with a smaller id, by blockwise suffix sorting.

Only suffixes that can matter are sorted, and only one bucket of them at a time:

1. Every window of ``length`` bytes has an anchor, the leftmost ``GRAM`` bytes of least hash
   in it. Equal windows have equal anchors at equal offsets, so a window whose anchor occurs
   once cannot repeat, and suffixes of different anchors need not be compared.
2. The neighbourhoods of repeated anchors, once per block and content, are dealt into suffix
   buckets by anchor. A bucket's suffixes are ordered by their first 16 bytes. Such prefixes
   tie nearly always between copies; ties are resolved by ranks that were computed before for
   a difference cover of the positions, {0, 1, 3} modulo 7. The cover is laid from the anchor,
   not from the text's start: equal suffixes then stand in the same residue, so the shift to
   a common cover position depends on one of them alone. Nothing longer than a neighbourhood
   (``2 * length`` bytes) is compared, and a bucket's size is set by the bucket count, so
   memory stays bounded however long repeats are.

Whole texts that equal one with a smaller id are settled first and take no further part.
Null ids count as smaller than all others; rows with equal ids do not remove each other's
bytes. A null text has no bytes. Tables without rows give none.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import blocks as B
from tripstrata.llm import grams as G

LENGTH = 50
GRAM = 20
NULL_ID = np.iinfo(np.int64).min
#: Blocks are small, as all their hashes are held; anchors of one, about.
_BLOCK_BYTES, _PER_BLOCK = 2 << 20, 150_000
#: Suffix buckets are finer than those of anchors, as their windows are laid out in memory.
_FINER = 4
_TEXTS, _ANCHORS, _SUFFIXES = 0, 1, 2
_COVER, _PERIOD = (0, 1, 3), 7
_HEAD = 16

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


class _Slice:
    """Windows of a few texts."""

    def __init__(self, part: G.Texts, length: int) -> None:
        self.part, self.length = part, length
        n = len(part.data) - length + 1
        steps = np.zeros(max(n, 0) + 1, dtype=np.int32)
        if n > 0:
            inner = part.offsets[1:-1]
            np.add.at(steps, np.clip(inner - length + 1, 0, n), 1)
            np.add.at(steps, np.clip(inner, 0, n), -1)
        self.live = np.cumsum(steps[:-1]) == 0
        self.hashes = G.gram_hashes(G.prefix_codes(part.data), GRAM)

        self.width = length - GRAM + 1
        self.chosen = np.flatnonzero(G.winnow(self.hashes, self.live, self.width))

    def anchors(self) -> np.ndarray:
        return self.hashes[self.chosen]

    def narrow(self, anchors: np.ndarray, several: np.ndarray, copy: np.ndarray) -> None:
        """Keep the windows whose anchor is repeated, with their anchors."""
        left = np.flatnonzero(self.live)
        text = np.searchsorted(self.part.offsets, left, side="right") - 1
        left = left[~copy[text]]
        least = G.sliding(self.hashes, self.width, np.minimum)[left]
        kept = several[np.searchsorted(anchors, least)]
        self.left, least = left[kept], least[kept]
        # The anchor is the first chosen place from the start on that holds the least hash.
        spot = np.searchsorted(self.chosen, self.left)
        wrong = np.flatnonzero(self.hashes[self.chosen[spot]] != least) if len(spot) else spot
        while len(wrong):
            spot[wrong] += 1
            wrong = wrong[self.hashes[self.chosen[spot[wrong]]] != least[wrong]]
        self.at = self.chosen[spot]

    def runs(self):
        """Runs of windows with one anchor: first start, end of starts, anchor."""
        left, at = self.left, self.at
        fresh = np.ones(len(left), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1]) | (left[1:] != left[:-1] + 1)
        first = np.flatnonzero(fresh)
        last = np.concatenate([first[1:], [len(left)]]).astype(np.int64) - 1
        return left[first], left[last] + 1 if len(left) else left[:0], at[first]


class _Block:
    def __init__(self, table: pa.Table, length: int, bits: int) -> None:
        self.length, self.bits = length, bits
        self.texts = G.texts(table["text"])
        self.ids = table["doc_id"].fill_null(NULL_ID).to_numpy().astype(np.int64)
        self.copy = np.zeros(len(self.texts), dtype=bool)
        self.pieces = [(first, _Slice(part, length)) for first, part in G.slices(self.texts)]

    def whole_texts(self):
        """Texts of at least one window, sorted by digest and id; which lead their digest."""
        rows = np.flatnonzero(np.diff(self.texts.offsets) >= self.length)
        hashes, check = G.digests(self.texts.bytes_of(i) for i in rows)
        order = np.lexsort([self.ids[rows], check, hashes])
        keys = [hashes[order], check[order]]
        return rows[order], keys, B.changes(keys)

    def ask_first(self, block: int) -> pa.Table:
        order, keys, lead = self.whole_texts()
        columns = [keys[1][lead], self.ids[order][lead]]
        texts = B.question(
            block,
            _TEXTS,
            self.bits,
            keys[0][lead],
            lambda a, b: b"".join(B.planes(np.ascontiguousarray(c[a:b])) for c in columns),
        )
        asked, counts = np.unique(self.anchors(), return_counts=True)
        anchors = B.question(
            block, _ANCHORS, self.bits, asked, lambda a, b: np.packbits(counts[a:b] > 1).tobytes()
        )
        return pa.concat_tables([texts, anchors])

    def anchors(self) -> np.ndarray:
        found = [piece.anchors() for _, piece in self.pieces]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)

    def settle(self, replies: pa.Table) -> None:
        order, keys, lead = self.whole_texts()
        first = B.read_answer(replies, _TEXTS, self.bits, keys[0][lead])
        group = np.cumsum(lead) - 1
        ids = self.ids[order]
        self.copy[order[(ids > ids[lead][group]) | ~first[group]]] = True
        known = np.unique(self.anchors())
        several = B.read_answer(replies, _ANCHORS, self.bits, known)
        for first, piece in self.pieces:
            piece.narrow(known, several, self.copy[first : first + len(piece.part)])

    def narrowed(self):
        """Slices with the windows left, and their runs."""
        for first, piece in self.pieces:
            yield first, piece, *piece.runs()

    def neighbourhoods(self):
        """All runs as (anchor's hash, offset, content, id), sorted, with place in the block."""
        keys, place = [], []
        for number, (first, piece, start, stop, at) in enumerate(self.narrowed()):
            text = first + np.searchsorted(piece.part.offsets, start, side="right") - 1
            raw = piece.part.data.tobytes()
            ends = stop + self.length - 1
            content = [raw[a:b] for a, b in zip(start.tolist(), ends.tolist())]
            keys += zip(
                piece.hashes[at].tolist(), (at - start).tolist(), content, self.ids[text].tolist()
            )
            place += [(number, i) for i in range(len(start))]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        return [keys[i] for i in order], [place[i] for i in order]

    def ask_suffixes(self, block: int) -> pa.Table:
        keys, _ = self.neighbourhoods()
        leads = [k for i, k in enumerate(keys) if not i or k[:3] != keys[i - 1][:3]]
        ids = np.array([k[3] for k in leads], dtype=np.int64)

        def more(a: int, b: int) -> bytes:
            head = np.array([(k[1], len(k[2])) for k in leads[a:b]], dtype=np.uint8)
            content = b"".join(k[2] for k in leads[a:b])
            return head.T.tobytes() + B.planes(ids[a:b].copy()) + content

        hashes = np.array([k[0] for k in leads], dtype=np.uint64)
        return B.question(block, _SUFFIXES, self.bits + _FINER, hashes, more, send=False)

    def removed(self, replies: pa.Table) -> np.ndarray:
        """Which bytes are covered by a window that also starts in a text of smaller id."""
        keys, place = self.neighbourhoods()
        rows = [r for r in replies.to_pylist() if r["level"] == _SUFFIXES]
        said = b"".join(r["bits"] for r in sorted(rows, key=lambda r: r["bucket"]))
        masks = np.frombuffer(said, dtype=np.uint32)
        answers: dict[int, dict[int, int]] = {}
        group, lead_id = -1, None
        for i, (key, (number, run)) in enumerate(zip(keys, place)):
            if not i or key[:3] != keys[i - 1][:3]:
                group, lead_id = group + 1, key[3]
            every = (1 << (len(key[2]) - self.length + 1)) - 1
            mask = int(masks[group]) if key[3] == lead_id else every
            if mask:
                answers.setdefault(number, {})[run] = mask
        gone = np.zeros(len(self.texts.data), dtype=bool)
        for number, (first, piece, start, _, _) in enumerate(self.narrowed()):
            if number not in answers:
                continue
            runs = np.array(list(answers[number]), dtype=np.int64)
            bits = np.array(list(answers[number].values()), dtype=np.uint32)
            which, shift = np.nonzero((bits[:, None] >> np.arange(32, dtype=np.uint32)) & 1)
            starts = start[runs[which]] + shift
            steps = np.zeros(len(piece.part.data) + 1, dtype=np.int32)
            np.add.at(steps, starts, 1)
            np.add.at(steps, starts + self.length, -1)
            base = self.texts.offsets[first]
            gone[base : base + len(piece.part.data)] = np.cumsum(steps[:-1]) > 0
        for i in np.flatnonzero(self.copy):
            gone[self.texts.offsets[i] : self.texts.offsets[i + 1]] = True
        return gone


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number, in the order of bytes."""
    wide = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), dtype=np.uint64)
    for j in range(8):
        out |= wide[j : j + len(data)] << np.uint64(56 - 8 * j)
    return out


def _dense(columns: list[np.ndarray]) -> np.ndarray:
    """Rank of every row among the distinct rows in sorted order."""
    order = np.lexsort(columns[::-1])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(B.changes([c[order] for c in columns])) - 1
    return rank


def suffix_ranks(data: np.ndarray, start: np.ndarray, anchor: np.ndarray, length: int):
    """Ranks of the ``length`` bytes from ``start``, equal for equal windows.

    ``anchor`` is the position from which the cover is laid, for every window.
    """
    words = _words8(data)
    depth = length - _HEAD
    residue = (start - anchor) % _PERIOD
    shift = np.array([min((c - r) % _PERIOD for c in _COVER) for r in range(_PERIOD)])
    sample = start + shift[residue]
    cover, back = np.unique(sample, return_inverse=True)
    inside = [words[cover + j] for j in range(0, depth - 7, 8)]
    ranks = _dense([*inside, words[cover + depth - 8]])[back]
    ends = [words[start + length - _HEAD], words[start + length - 8]]
    return _dense([start - anchor, words[start], words[start + 8], ranks, *ends])


def _least_owner(spots: list[tuple[int, bytes]], least: np.ndarray, length: int):
    """For neighbourhoods that share their anchor with others: the least id of each window."""
    seen = Counter(content[offset : offset + GRAM] for offset, content in spots)
    number = np.array(
        [i for i, (o, c) in enumerate(spots) if seen[c[o : o + GRAM]] > 1], dtype=np.int64
    )
    most = np.iinfo(np.int64).max
    if not len(number):
        return number, np.full((0, 1), most)
    some = [spots[i] for i in number]
    sizes = np.array([len(c) for _, c in some])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    counts = sizes - length + 1
    text = np.repeat(np.arange(len(sizes)), counts)
    shift = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    anchor = begin[:-1] + np.array([o for o, _ in some])
    data = np.frombuffer(b"".join(c for _, c in some), dtype=np.uint8)
    rank = suffix_ranks(data, begin[text] + shift, anchor[text], length)
    first = np.full(rank.max() + 1, most)
    np.minimum.at(first, rank, least[number][text])
    table = np.full((len(sizes), int(counts.max())), most)
    table[text, shift] = first[rank]
    return number, table


def _smaller_starts(rows: list[dict], length: int) -> list[bytes]:
    """Per asked neighbourhood, the windows that also start under a smaller id, as bits."""
    numbers: dict[tuple[int, bytes], int] = {}
    which, ids = [], []
    for r in rows:
        n, raw = r["n"], r["more"]
        head = np.frombuffer(raw[: 2 * n], dtype=np.uint8).reshape(2, n)
        ids.append(B.from_planes(raw[2 * n : 10 * n], n, "int64"))
        spot = 10 * n
        for offset, size in zip(head[0].tolist(), head[1].tolist()):
            key = (offset, raw[spot : spot + size])
            which.append(numbers.setdefault(key, len(numbers)))
            spot += size
    owner, group = np.concatenate(ids), np.array(which)
    least = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(least, group, owner)
    first = _least_owner(list(numbers), least, length)
    counts = np.array([len(c) - length + 1 for _, c in numbers], dtype=np.uint32)
    every = (np.uint64(1) << counts.astype(np.uint64)) - np.uint64(1)
    # A neighbourhood that stands alone at its anchor repeats as a whole or not at all.
    masks = np.where(least[group] < owner, every[group], 0).astype(np.uint32)
    number, table = first
    row = np.full(len(numbers), -1)
    row[number] = np.arange(len(number))
    mixed = np.flatnonzero(row[group] >= 0)
    bits = np.uint32(1) << np.arange(table.shape[1], dtype=np.uint32)
    for part in np.array_split(mixed, max(1, len(mixed) >> 15)):
        smaller = table[row[group[part]]] < owner[part][:, None]
        masks[part] = (smaller * bits).sum(axis=1, dtype=np.uint32)
    edges = np.cumsum([0, *(r["n"] for r in rows)])
    return [masks[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]


def _judge(length: int):
    def judge(rows: list[dict]) -> list[bytes]:
        level = rows[0]["level"]
        if level == _TEXTS:
            return B.earliest(rows, ["uint32", "*int64"])
        return B.repeated(rows) if level == _ANCHORS else _smaller_starts(rows, length)

    return judge


def _kept_rows(block: _Block, table: pa.Table, gone: np.ndarray) -> pa.Table:
    offsets = block.texts.offsets
    edge = np.zeros(len(gone), dtype=bool)
    edge[1:] = gone[:-1]
    starts = offsets[:-1][offsets[:-1] < len(gone)]
    edge[starts] = False
    total, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, gone & ~edge))
    kept = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        part = block.texts.data[a:b]
        kept.append((part[~gone[a:b]] if total[b] > total[a] else part).tobytes())
    return pa.table(
        {
            "doc_id": table["doc_id"],
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(total[offsets[1:]] - total[offsets[:-1]], pa.int64()),
            "n_spans": pa.array(spans[offsets[1:]] - spans[offsets[:-1]], pa.int64()),
            "kept": pa.array(kept, pa.binary()),
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
        }
    )


def remove_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every text without the bytes of ``length``-byte strings that start under a smaller id.

    ``length`` is 50 to 51, as neighbourhoods are marked by 32 bits. Returns ``doc_id``,
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (bytes, which
    need not be whole characters) and ``kept_sha256``, one row for each row of ``docs``.
    """
    if not 2 * _HEAD + 8 < length <= GRAM + 31:
        raise ValueError(f"length must be above {2 * _HEAD + 8} and at most {GRAM + 31}")
    blocks = B.n_blocks(docs, text_col, _BLOCK_BYTES)
    bits = B.bucket_bits(blocks, _PER_BLOCK)
    table = B.store(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
        blocks,
    ).select("block", "row_id", "doc_id", "text")
    judge = _judge(length)

    def ask_first(left: pa.Table) -> pa.Table:
        return _Block(left, length, bits).ask_first(left["block"][0].as_py())

    def settled(left: pa.Table, right: pa.Table) -> _Block:
        block = _Block(left, length, bits)
        block.settle(right)
        return block

    def ask_suffixes(left: pa.Table, right: pa.Table) -> pa.Table:
        return settled(left, right).ask_suffixes(left["block"][0].as_py())

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        block = settled(left, right)
        return _kept_rows(block, left, block.removed(right))

    by_block = table.groupBy("block")
    replies = B.keep(B.answer(by_block.applyInArrow(ask_first, B.ASKED), judge), "suffix-answers")
    asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(ask_suffixes, B.ASKED)
    replies = replies.unionByName(B.keep(B.answer(asked, judge), "suffix-answers"))
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(finish, RESULT)
