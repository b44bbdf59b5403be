"""Byte-pair encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token that ends its encoding. An
automaton over the vocabulary lists the tokens that end at each position; the last token of a
prefix is the one whose pair with the last token of what stands before it is compatible, that
is, encodes to just these two. Following the tokens back from the end gives the ids.

Two tokens are compatible if no merge across their border would have come before the merges
that made them. Only the pieces along the right edge of the one and the left edge of the
other ever touch, so the test looks at these alone.

Texts are cut into pieces by the tokenizer's own pattern first, and pieces are remembered in a
table of bounded size. A null text is empty. Decoding joins the tokens' bytes; bytes that are
no UTF-8 are replaced as the public library does.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces remembered by one worker; only speed depends on it.
REMEMBERED = 300_000
#: Characters of texts encoded at a time.
CHUNK_CHARS = 1 << 20

# The public pattern of byte-level BPE, as is and for texts of Latin-1 letters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN_LETTER, LATIN_NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
LATIN_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN_LETTER}]+| ?[{LATIN_NUMBER}]+"
    rf"| ?[^\s{LATIN_LETTER}{LATIN_NUMBER}]+|\s+(?!\S)|\s+"
)
# Python and the tokenizer agree on what is a space among these characters.
LATIN_TEXT = re.compile("[\t-\r -~\xa0-\xff]*")


@lru_cache
def byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_alphabet()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        ids = spec["model"]["vocab"]
        self.token_bytes = {i: as_bytes(t) for t, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.added.items()}
        self.merges: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair = ids[a], ids[b]
            self.merges[pair] = rank
            made.setdefault(ids[a + b], (rank, *pair))
        self._made = made
        self._right: dict[int, list[tuple[int, float]]] = {}
        self._left: dict[int, list[tuple[int, float]]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            if i in made and not self._whole(i):
                continue
            raw = self.token_bytes[i].decode("latin-1")
            self.automaton.add_word(raw, (i, len(raw)))
        self.automaton.make_automaton()
        self._fits: dict[int, bool] = {}

    def _whole(self, token: int) -> bool:
        """Does the token's text encode to the token itself?"""
        _, a, b = self._made[token]
        rank = self._made[token][0]
        return self._first_crossing(a, b) == rank

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces of a token at its right (2) or left (1) border, each with the rank of the
        merge that swallows it."""
        known = self._right if side == 2 else self._left
        if token not in known:
            out, rank, piece = [], float("inf"), token
            while True:
                out.append((piece, rank))
                if piece not in self._made:
                    break
                rank, piece = self._made[piece][0], self._made[piece][side]
            known[token] = out
        return known[token]

    def _first_crossing(self, a: int, b: int) -> float:
        best = float("inf")
        for x, x_end in self.edge(a, 2):
            for y, y_end in self.edge(b, 1):
                rank = self.merges.get((x, y))
                # Of equal merges the left one comes first.
                if rank is not None and rank < x_end and rank <= y_end and rank < best:
                    best = rank
        return best

    def fits(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > REMEMBERED:
                self._fits.clear()
            known = self._fits[key] = self._first_crossing(a, b) == float("inf")
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece, by the last token of each of its prefixes."""
        last: list[tuple[int, int] | None] = [None] * (len(piece) + 1)
        for end, (token, size) in self.automaton.iter(piece.decode("latin-1")):
            if last[end + 1] is not None:
                continue
            start = end + 1 - size
            before = last[start]
            if not start or before is not None and self.fits(before[0], token):
                last[end + 1] = token, start
        out, at = [], len(piece)
        while at:
            token, at = last[at]
            out.append(token)
        return out[::-1]


class Encoder:
    """Encodes texts; pieces seen before are looked up."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.any = regex.compile(PATTERN)
        self.latin = re.compile(LATIN_PATTERN)
        names = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.known: dict[str, bytes] = {}
        size = max(self.vocabulary.token_bytes) + 1
        sizes = np.zeros(size, dtype=np.int64)
        for i, raw in self.vocabulary.token_bytes.items():
            sizes[i] = len(raw)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        whole = b"".join(self.vocabulary.token_bytes.get(i, b"") for i in range(size))
        self.bytes = np.frombuffer(whole, dtype=np.uint8)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if self.added and any(name in text for name in self.vocabulary.added):
            parts = self.added.split(text)
            return b"".join(
                np.array([self.vocabulary.added[p]], "<i4").tobytes() if i % 2 else self._plain(p)
                for i, p in enumerate(parts)
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        cut = self.latin if LATIN_TEXT.fullmatch(text) else self.any
        pieces = cut.findall(text)
        known = self.known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for p in pieces:
            if p not in known:
                known[p] = np.array(self.vocabulary.encode_piece(p.encode()), "<i4").tobytes()
        return b"".join([known[p] for p in pieces])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, one after the other."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        spots = np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.bytes[spots].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_and_decode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """Token ids of every text and the text they decode to.

    ``path`` is the place of the vocabulary file on every executor. Returns ``doc_id``, ``ids``
    (array of int) and ``decoded``, one row for each row of ``docs``; with ``carry`` also
    ``rest``, a struct of all columns of ``docs``.
    """
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    schema = "doc_id long, ids array<int>, decoded string"
    if carry:
        rest = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("rest"))
        columns.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("rest"))
        schema += f", rest {rest.schema['rest'].dataType.simpleString()}"

    def run(batches):
        code = encoder(path)
        for batch in batches:
            for part in small_parts(batch):
                rows = [code.encode(t or "") for t in part["text"].to_pylist()]
                values = np.frombuffer(b"".join(rows), dtype="<i4")
                edges = np.cumsum([0, *(len(r) // 4 for r in rows)])
                decoded = [
                    code.decode(values[a:b]).decode("utf-8", "replace")
                    for a, b in zip(edges[:-1], edges[1:])
                ]
                ids = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values))
                arrays = [part["doc_id"], ids, pa.array(decoded, pa.string())]
                names = ["doc_id", "ids", "decoded"]
                if carry:
                    arrays.append(part["rest"])
                    names.append("rest")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(*columns).mapInArrow(run, schema)


def small_parts(batch: pa.RecordBatch, column: str = "text"):
    """A batch in runs of rows whose texts have about ``CHUNK_CHARS`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(
        zero_copy_only=False
    )
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        limit = (ends[first - 1] if first else 0) + CHUNK_CHARS
        last = max(first + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(first, last - first)
        first = last
