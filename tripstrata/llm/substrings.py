"""Word passages that repeat across a corpus, found by level-wise doubling.

A passage of ``window`` words can repeat only if its parts do. Windows of ``first`` words are
asked about at one level, those repeated are extended to twice the length and asked about
again, until the length is ``window``; what survives the last level is repeated. Below the
last level a long window is stood for by the shorter windows of least hash in it: equal long
windows choose equal short ones, so no repetition is lost by asking about these alone.

Whole texts that equal an earlier one are settled at the first question and ask no more.

Places are ordered by (doc_id, word position). Null ids come before all others. Rows with one
and the same id are not earlier than each other, so neither loses words to the other at the
same position. A null or empty text has no words. Tables without rows give none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripstrata.llm import blocks as B
from tripstrata.llm import grams as G

WINDOW = 20
FIRST = 5
NULL_ID = np.iinfo(np.int64).min
#: Hashes a block asks about at one level, about.
_PER_BLOCK = 80_000
_TEXTS = 0
_OWNER = ["uint32", "*int64", "int32"]

RESULT = "row_id long, doc_id long, text string, n_words long, n_removed long, kept_sha256 string"


def levels(window: int, first: int) -> list[int]:
    """Lengths from about ``first`` words, each twice the one before, up to ``window``."""
    out = [window]
    while out[0] % 2 == 0 and out[0] // 2 >= first:
        out.insert(0, out[0] // 2)
    return out


class _Block:
    """The windows of one block's texts, as far as the answers given so far settle them."""

    def __init__(self, table: pa.Table, window: int, first: int, bits: int) -> None:
        self.texts = G.texts(table["text"])
        self.words = G.words(self.texts)
        self.hashes = G.word_hashes(self.texts, self.words)
        self.ids = table["doc_id"].fill_null(NULL_ID).to_numpy().astype(np.int64)
        self.lengths, self.window, self.bits = levels(window, first), window, bits
        self.live = G.same_text(self.words.text, window)
        self.copy = np.zeros(len(self.texts), dtype=bool)

    def whole_texts(self):
        """Digest of the words of every text that has a window, in two columns."""
        counts = np.diff(self.words.first)
        rows = np.flatnonzero(counts >= self.window)
        return rows, *G.digests(b" ".join(self.texts.bytes_of(i).split()) for i in rows)

    def settle_copies(self, replies: pa.Table) -> None:
        rows, hashes, check = self.whole_texts()
        lead, order, _ = _leads([hashes, check], [self.ids[rows]])
        first = B.read_answer(replies, _TEXTS, self.bits, hashes[order][lead])
        group = np.cumsum(lead) - 1
        best = self.ids[rows][order][lead][group]
        later = (self.ids[rows][order] > best) | ~first[group]
        self.copy[rows[order[later]]] = True
        if len(self.live):
            self.live &= ~self.copy[self.words.text[: len(self.live)]]

    def codes(self, length: int, hashes: np.ndarray) -> np.ndarray:
        out = G.chain(hashes, self.lengths[0])
        k = self.lengths[0]
        while k < length:
            out, k = G.double(out, k), 2 * k
        return out

    def chosen(self, level: int):
        length = self.lengths[level]
        hashes = G.mix(self.codes(length, self.hashes))
        at = G.winnow(hashes, self.live, self.window - length + 1)
        return hashes, at

    def narrow(self, level: int, replies: pa.Table) -> None:
        """Drop windows whose least hash is not repeated; others in them prove nothing."""
        hashes, at = self.chosen(level)
        asked = np.unique(hashes[at])
        several = B.read_answer(replies, level + 1, self.bits, asked)
        left = np.flatnonzero(self.live)
        width = self.window - self.lengths[level] + 1
        least = G.sliding(hashes, width, np.minimum)[left]
        self.live[left] = several[np.searchsorted(asked, least)]

    def survivors(self):
        """Surviving windows: position, hash, second hash, id and place in their text."""
        at = np.flatnonzero(self.live)
        hashes = G.mix(self.codes(self.window, self.hashes)[at])
        other = self.codes(self.window, G.word_hashes(self.texts, self.words, seed=1))[at]
        text = self.words.text[at]
        place = (at - self.words.first[text]).astype(np.int32)
        return at, hashes, (G.mix(other) >> np.uint64(32)).astype(np.uint32), self.ids[text], place

    def ask(self, block: int, level: int) -> pa.Table:
        """The question of one level; the first also asks about whole texts."""
        if level == len(self.lengths) - 1:
            _, hashes, check, ids, place = self.survivors()
            return self._ask_first(block, level + 1, [hashes, check], [ids, place])
        hashes, at = self.chosen(level)
        asked, counts = np.unique(hashes[at], return_counts=True)
        twice = counts > 1
        return B.question(
            block, level + 1, self.bits, asked, lambda a, b: np.packbits(twice[a:b]).tobytes()
        )

    def ask_texts(self, block: int) -> pa.Table:
        rows, hashes, check = self.whole_texts()
        place = np.zeros(len(rows), np.int32)
        return self._ask_first(block, _TEXTS, [hashes, check], [self.ids[rows], place])

    def _ask_first(self, block, level, keys, place) -> pa.Table:
        lead, order, _ = _leads(keys, place)
        columns = [c[order][lead] for c in [*keys, *place]]
        return B.question(
            block,
            level,
            self.bits,
            columns[0],
            lambda a, b: b"".join(B.planes(np.ascontiguousarray(c[a:b])) for c in columns[1:]),
        )

    def removed(self, replies: pa.Table) -> np.ndarray:
        """Which words are covered by a window that also starts earlier."""
        at, *columns = self.survivors()
        lead, order, group = _leads(columns[:2], columns[2:])
        first = B.read_answer(
            replies, len(self.lengths), self.bits, columns[0][order][lead]
        )
        ids, place = columns[2][order], columns[3][order]
        later = (ids != ids[lead][group]) | (place != place[lead][group]) | ~first[group]
        steps = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        starts = at[order[later]]
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + self.window, -1)
        return (np.cumsum(steps[:-1]) > 0) | self.copy[self.words.text]


def _leads(keys: list[np.ndarray], place: list[np.ndarray]):
    """Sort by keys and place; mark the first of each key, and number the keys."""
    order = np.lexsort([*place[::-1], *keys[::-1]])
    lead = B.changes([k[order] for k in keys])
    return lead, order, np.cumsum(lead) - 1


def _kept_rows(block: _Block, table: pa.Table, gone: np.ndarray, carry: bool = False) -> pa.Table:
    n = len(block.texts)
    counts = np.diff(block.words.first)
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = total[block.words.first[1:]] - total[block.words.first[:-1]]
    kept, words = [], []
    for i in range(n):
        raw = block.texts.bytes_of(i).split()
        if removed[i]:
            drop = gone[block.words.first[i] : block.words.first[i + 1]]
            raw = [w for w, d in zip(raw, drop) if not d]
        words.append(b" ".join(raw))
        kept.append(words[-1] if removed[i] or not carry else block.texts.bytes_of(i))
    out = pa.table(
        {
            "row_id": table["row_id"],
            "doc_id": table["doc_id"],
            "text": pa.array(kept, pa.binary()).cast(pa.string()),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in words],
        }
    )
    return out.append_column("rest", table["rest"]) if carry else out


def _judge(last: int):
    def judge(rows: list[dict]) -> list[bytes]:
        if rows[0]["level"] in (_TEXTS, last):
            return B.earliest(rows, _OWNER)
        return B.repeated(rows)

    return judge


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    first: int = FIRST,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """Every text without the words of windows that also start earlier in the corpus.

    Returns ``doc_id``, ``text`` (the kept words, one space between), ``n_words``,
    ``n_removed`` and ``kept_sha256``; with ``carry`` also ``rest``, a struct of the
    other columns of ``docs``, and texts that lose nothing keep their white space. Every row of ``docs`` gives one row.
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
    table = stored.select("block", "row_id", "doc_id", "text")
    lengths = levels(window, first)
    judge = _judge(len(lengths))

    def block_of(left: pa.Table, replies: pa.Table | None, upto: int) -> _Block:
        block = _Block(left, window, first, bits)
        if upto:
            # In the order of asking: copies were not yet known at the first question.
            block.narrow(0, replies)
            block.settle_copies(replies)
            for level in range(1, upto):
                block.narrow(level, replies)
        return block

    def ask_first(left: pa.Table) -> pa.Table:
        number = left["block"][0].as_py()
        block = block_of(left, None, 0)
        return pa.concat_tables([block.ask_texts(number), block.ask(number, 0)])

    asked = table.groupBy("block").applyInArrow(ask_first, B.ASKED)
    replies = B.keep(B.answer(asked, judge), "repeat-answers")

    def asker(level: int):
        def ask_next(left: pa.Table, right: pa.Table) -> pa.Table:
            return block_of(left, right, level).ask(left["block"][0].as_py(), level)

        return ask_next

    for level in range(1, len(lengths)):
        both = table.groupBy("block").cogroup(replies.groupBy("block"))
        asked = both.applyInArrow(asker(level), B.ASKED)
        replies = replies.unionByName(B.keep(B.answer(asked, judge), "repeat-answers"))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        block = block_of(left, right, len(lengths) - 1)
        return _kept_rows(block, left, block.removed(right), carry)

    schema = StructType.fromDDL(RESULT)
    if carry:
        table = stored.select("block", "row_id", "doc_id", "text", "rest")
        schema = schema.add(stored.schema["rest"])
    both = table.groupBy("block").cogroup(replies.groupBy("block"))
    return both.applyInArrow(finish, schema).drop("row_id")
