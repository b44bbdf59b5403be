"""Token ids in files that give random access: directly addressable codes.

An id is cut into chunks of eight bits, least first. Level 0 holds the first chunk of every
id, level 1 the second chunk of those ids that go on, and so on. Each level has a bitmap of
the ids that go on, and a directory of how many do before each run of ``RANK_BITS``. The
place of an id's next chunk is its rank in the bitmap, so any single id is read by a few
look-ups and nothing else is decoded.

A file is one segment: whole documents in ascending order of id, about ``SEGMENT_IDS`` ids.
All numbers are little-endian. Layout: ``MAGIC``, then int64 shard, number in the shard,
documents, ids and levels; document ids (int64, null as the least), ends of documents (int64);
for each level its length (int64), chunks, bitmap and directory (uint32).

Null texts are empty and have the end id only. Null document ids come first. Rows of equal
document id are ordered by their ids. Tables without rows give no file and no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


from tripstrata.llm.bpe import LATIN_NUMBER, LATIN_TEXT, byte_alphabet, small_parts
from tripstrata.sources.workspace import new_folder

MAGIC = b"DACIDS01"
RANK_BITS = 512
SEGMENT_IDS = 1 << 21
#: Bytes of text for one shard, about, and the most shards: their bounds are on the driver.
SHARD_BYTES, MAX_SHARDS = 16 << 20, 10_000
#: Words that a process remembers, some 120 bytes each.
REMEMBERED = 500_000
NULL_ID = np.iinfo(np.int64).min

# The tokenizer's pattern for lower-case texts of Latin-1 letters.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+"
    rf"|[{LATIN_NUMBER}]|[^\sa-zªµºß-öø-ÿ{LATIN_NUMBER}]+"
)


def encode_levels(ids: np.ndarray) -> list[bytes]:
    """Chunks, bitmap and rank directory of every level."""
    out, rest = [], ids.astype(np.uint32)
    while len(rest):
        on = rest > 0xFF
        padded = np.zeros(math.ceil(len(on) / RANK_BITS) * RANK_BITS, dtype=bool)
        padded[: len(on)] = on
        counts = padded.reshape(-1, RANK_BITS).sum(axis=1)
        ranks = (np.cumsum(counts) - counts).astype("<u4")
        bitmap = np.packbits(padded, bitorder="little").tobytes()
        chunks = (rest & 0xFF).astype(np.uint8).tobytes()
        out.append(np.int64(len(rest)).tobytes() + chunks + bitmap + ranks.tobytes())
        rest = rest[on] >> 8
    return out


class Segment:
    """One file's content; nothing is decoded until it is asked for."""

    def __init__(self, raw: bytes) -> None:
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        self.shard, self.number, n_docs, self.n_ids, n_levels = np.frombuffer(raw, "<i8", 5, 8)
        at = 48
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
        self.ends = np.frombuffer(raw, "<i8", n_docs, at + 8 * n_docs)
        at += 16 * n_docs
        self.levels = []
        for _ in range(n_levels):
            n = int(np.frombuffer(raw, "<i8", 1, at)[0])
            blocks = math.ceil(n / RANK_BITS)
            chunks = np.frombuffer(raw, np.uint8, n, at + 8)
            at += 8 + n
            bitmap = np.frombuffer(raw, np.uint8, blocks * RANK_BITS // 8, at)
            at += len(bitmap)
            ranks = np.frombuffer(raw, "<u4", blocks, at)
            at += 4 * blocks
            self.levels.append((chunks, bitmap, ranks))

    def get(self, position: int) -> int:
        """The id at one position."""
        value, shift = 0, 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[position]) << shift
            shift += 8
            if not bitmap[position >> 3] >> (position & 7) & 1:
                return value
            block = position // RANK_BITS
            before = bitmap[block * RANK_BITS // 8 : position >> 3]
            partial = int(bitmap[position >> 3]) & ((1 << (position & 7)) - 1)
            position = (
                int(ranks[block]) + int(np.bitwise_count(before).sum()) + partial.bit_count()
            )
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        out = np.zeros(self.n_ids, dtype="<u4")
        at = np.arange(self.n_ids)
        for depth, (chunks, bitmap, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * depth)
            on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
            at = at[on]
        return out


def segment(shard: int, number: int, doc_ids: list[int], rows: list[np.ndarray]) -> bytes:
    ids = np.concatenate(rows)
    levels = encode_levels(ids)
    head = np.array([shard, number, len(rows), len(ids), len(levels)], "<i8")
    ends = np.cumsum([len(r) for r in rows]).astype("<i8")
    return b"".join(
        [MAGIC, head.tobytes(), np.array(doc_ids, "<i8").tobytes(), ends.tobytes(), *levels]
    )


class WordEncoder:
    """Encodes as the tokenizer file says; words seen before are looked up.

    The library encodes every word once. Texts of Latin-1 characters are cut into words here,
    as the file's normaliser and pattern cut them; of others, each part between spaces is
    given to the library whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.cut = re.compile(WORD_PATTERN)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        letters = {b: c for c, b in byte_alphabet().items()}
        self.letters = [letters[b] for b in range(256)]
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if any(name in text for name in self.added):
            return self._by_library(text)
        if LATIN_TEXT.fullmatch(text):
            return self._latin(text)
        out = []
        for part in re.split("[ \t-\r]+", text):
            if LATIN_TEXT.fullmatch(part):
                out.append(self._latin(part))
            else:
                if part not in self.parts:
                    if len(self.parts) > REMEMBERED:
                        self.parts.clear()
                    self.parts[part] = self._by_library(part)
                out.append(self.parts[part])
        return b"".join(out)

    def _by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _latin(self, text: str) -> bytes:
        words = self.cut.findall(text.lower())
        known = self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                spelled = "".join([self.letters[b] for b in w.encode()])
                ids = [t.id for t in self.model.tokenize(spelled)]
                known[w] = np.array(ids, "<u4").tobytes()
        return b"".join([known[w] for w in words])


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def shard_bounds(docs: DataFrame, id_col: str, text_col: str) -> list[int]:
    """Document ids that cut the corpus into shards; at most ``MAX_SHARDS``."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    n = min(MAX_SHARDS, math.ceil(total / SHARD_BYTES))
    if n < 2:
        return []
    cuts = [i / n for i in range(1, n)]
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    return sorted(set(ids.approxQuantile("doc_id", cuts, 1 / (10 * n))))


def encoded(
    docs: DataFrame, path: str, end_id: int, bounds: list[int], id_col: str, text_col: str
) -> DataFrame:
    """Ids of every text with the end id, as the bytes of four planes, and the text's shard."""

    def run(batches):
        code = word_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in small_parts(batch):
                rows = []
                for text in part["text"].to_pylist():
                    ids = np.frombuffer(code.encode(text or "") + end, np.uint8)
                    rows.append(ids.reshape(-1, 4).T.tobytes())
                ids = part["doc_id"].fill_null(NULL_ID).to_numpy()
                shards = np.searchsorted(bounds, ids, side="right") if bounds else ids * 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.int64()), part["doc_id"], pa.array(rows, pa.binary())],
                    ["shard", "doc_id", "planes"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "shard long, doc_id long, planes binary")


def write_tokens(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every text and write the files of all shards to ``folder``.

    ``path`` is the place of the tokenizer's file on every executor.
    """
    bounds = shard_bounds(docs, id_col, text_col)
    rows = encoded(docs, path, end_id, bounds, id_col, text_col)
    rows = rows.repartition(len(bounds) + 1, "shard")
    rows = rows.sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "planes")

    def run(batches):
        yield from _segments(batches, SEGMENT_IDS)

    # Text is written byte for byte, so it carries any bytes; one row is one file, and the
    # line's end after it is no part of the segment.
    files = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    files.write.option("maxRecordsPerFile", 1).text(folder)


def _segments(batches, most_ids: int):
    """Files of sorted rows. Rows are taken a few at a time, and what the task's process keeps
    of the encoding, which is over by now, goes first."""
    word_encoder.cache_clear()
    shard, number, ids, held, size = None, 0, [], [], 0
    for part in (part for batch in batches for part in small_parts(batch, "planes")):
        for s, d, raw in zip(*(part[c].to_pylist() for c in ("shard", "doc_id", "planes"))):
            planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
            row = np.ascontiguousarray(planes.T).view("<u4").reshape(-1)
            if held and (s != shard or size + len(row) > most_ids):
                yield _written(segment(shard, number, ids, held))
                number, ids, held, size = number + 1, [], [], 0
            if s != shard:
                shard, number = s, 0
            ids.append(NULL_ID if d is None else d)
            held.append(row)
            size += len(row)
    if held:
        yield _written(segment(shard, number, ids, held))


def _written(raw: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["value"])


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32``, from
    the files of ``folder`` alone."""

    def run(batches):
        for batch in batches:
            for raw in batch["content"].to_pylist():
                found = Segment(raw)
                ids = found.all()
                starts = np.concatenate([[0], found.ends[:-1]])
                n = len(found.ends)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, found.ends)]
                shard, number = int(found.shard), int(found.number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * n, pa.int64()),
                        pa.array([number] * n, pa.int64()),
                        pa.array([None if d == NULL_ID else int(d) for d in found.doc_ids], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(found.ends - starts, pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array([int(found.n_ids)] * n, pa.int64()),
                    ],
                    ["shard", "number", "doc_id", "place", "n_tokens", "ids_crc32", "n_ids"],
                )

    schema = (
        "shard long, number long, doc_id long, place long, n_tokens long, ids_crc32 long, n_ids long"
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    heads = files.select(F.substring("content", 1, 48).alias("head"))

    def read_heads(batches):
        for batch in batches:
            found = [np.frombuffer(raw, "<i8", 5, 8) for raw in batch["head"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(h[i]) for h in found], pa.int64()) for i in (0, 1, 3)],
                ["shard", "number", "n_ids"],
            )

    sizes = heads.mapInArrow(read_heads, "shard long, number long, n_ids long")
    # Shards are few; within one, segments are summed apart from other shards.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("all_ids"))
    shards = shards.select("shard", F.coalesce(F.sum("all_ids").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.join(shards, "shard").select(
        "shard",
        "number",
        (F.col("shard_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base"),
    )
    rows = files.select("content").mapInArrow(run, schema).join(places, ["shard", "number"])
    return rows.select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
