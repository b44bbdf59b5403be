"""Words, shingles and byte strings of many texts at once, as numpy arrays over Arrow buffers.

A word is a run of bytes other than space and ``\\x09-\\x0D``, as in ``[^\\x20\\x09-\\x0D]+``.
Hashes have 64 bits; the hash of a span depends on its bytes only, not on where it stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_kept_powers = cache(_powers)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2**64; only the table for a slice is kept."""
    if n > SLICE_BYTES + 1:
        return _powers(int(base), n)
    return _kept_powers(int(base), SLICE_BYTES + 1)[:n]


@dataclass
class Texts:
    """Bytes of consecutive texts; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string column as bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    spots = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(spots):
        spots = np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return Texts(raw[spots[0] : spots[-1]], spots - spots[0])


def slices(whole: Texts, most: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """Whole texts in groups of about ``most`` bytes, with the index of the first."""
    first, n = 0, len(whole)
    while first < n:
        last = int(np.searchsorted(whole.offsets, whole.offsets[first] + most, side="right")) - 1
        last = min(n, max(last, first + 1))
        lo, hi = whole.offsets[first], whole.offsets[last]
        yield first, Texts(whole.data[lo:hi], whole.offsets[first : last + 1] - lo)
        first = last


@dataclass
class Words:
    """Words of consecutive texts: byte spans, owner text and where each text's words begin."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray


def words(part: Texts) -> Words:
    inside = ~_SPACE[part.data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = part.offsets[(part.offsets > 0) & (part.offsets < len(part.data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    text = np.searchsorted(part.offsets, start, side="right") - 1
    return Words(start, end, text, np.searchsorted(start, part.offsets))


def prefix_codes(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hashes`` takes the hash of any span."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers(_BASE, len(data)), out=out[1:])
    return out


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    shift = powers(_INVERSE, len(codes))
    return mix((codes[end] - codes[start]) * shift[start] + (end - start).astype(np.uint64))


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from every position."""
    n = len(codes) - 1 - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return mix((codes[k:] - codes[:-k]) * powers(_INVERSE, n))


def _factors(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + mix(np.array([seed], dtype=np.uint64)))


_kept_factors = cache(_factors)


def word_hashes(part: Texts, spans: Words, seed: int = 0) -> np.ndarray:
    """Hashes of all words, worked out a slice of texts at a time.

    Each place in a word has a factor of its own, so that no pattern of letters makes words
    agree, as patterns do with the powers of one factor. Every ``seed`` gives other hashes.
    """
    out = np.empty(len(spans.start), dtype=np.uint64)
    shift = np.uint64(seed % 63)
    codes = (_BYTE_CODES << shift) | (_BYTE_CODES >> (np.uint64(64) - shift)) if seed else _BYTE_CODES
    for first, some in slices(part):
        lo, (a, b) = part.offsets[first], spans.first[[first, first + len(some)]]
        if a == b:
            continue
        start, size = spans.start[a:b] - lo, spans.end[a:b] - spans.start[a:b]
        begin = np.cumsum(size) - size
        longest, total = int(size.max()), int(size.sum())
        factors = _kept_factors(4096, seed) if longest <= 4096 else _factors(longest, seed)
        place = np.arange(total) - np.repeat(begin, size)
        letters = some.data[np.repeat(start, size) + place]
        sums = np.add.reduceat(codes[letters] * factors[place], begin)
        out[a:b] = mix(sums + size.astype(np.uint64))
    return out


def digests(texts_: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of whole texts, 96 bits in two columns. Nobody can make unlike texts agree."""
    raw = b"".join(blake2b(t, digest_size=12).digest() for t in texts_)
    rows = np.frombuffer(raw, dtype=np.dtype([("a", "<u8"), ("b", "<u4")]))
    return rows["a"].copy(), rows["b"].copy()


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Unmixed code of the ``k`` words from every position."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done = hashes[:n].copy(), 1
    while done < k:
        out += power(_WORD_STEP, done) * hashes[done : done + n]
        done += 1
    return out


def double(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes of twice ``k`` words from those of ``k`` words."""
    if len(codes) <= k:
        return np.zeros(0, dtype=np.uint64)
    return codes[:-k] + power(_WORD_STEP, k) * codes[k:]


def same_text(owner: np.ndarray, k: int) -> np.ndarray:
    """Which runs of ``k`` items stay within one text."""
    n = len(owner) - k + 1
    return owner[:n] == owner[k - 1 :] if n > 0 else np.zeros(0, dtype=bool)


def sliding(values: np.ndarray, w: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``w`` consecutive values."""
    if len(values) < w:
        return values[:0]
    out, span = values, 1
    while span < w:
        step = min(span, w - span)
        out = pick(out[:-step], out[step:])
        span += step
    return out


def winnow(hashes: np.ndarray, whole: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the least hash of some window of ``w`` positions.

    ``whole`` says which windows count. Two equal windows have their least hashes at the
    same places, so a repeated window has every chosen position repeated.
    """
    chosen = np.zeros(len(hashes), dtype=bool)
    if not len(whole):
        return chosen
    least = np.where(whole, sliding(hashes, w, np.minimum), np.uint64(0))
    edge = np.zeros(w - 1, dtype=np.uint64)
    best = sliding(np.concatenate([edge, least, edge]), w, np.maximum)
    return (best == hashes) & (hashes > 0)
