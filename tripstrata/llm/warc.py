"""WARC archives with a two-level capture index.

Every record is a gzip member of its own, so it can be read by offset and length. Of records
with equal payloads the one of the largest page id is a response; the others are revisits
that refer to it and hold its HTTP header only.

The index holds one line per capture, sorted by reversed host, path and page id, in compressed
blocks. Shards of it are cut by key, and each shard is searched by binary search in the first
keys of its blocks, then in the one block found; what comes out are ranges of archives.
An archive is one file in a folder of its own name, of bounded bytes and records, so a lookup
opens the archives that its ranges name and no others. Where these are few, ranges are sent to
them and records are cut out where the archive is read. Beyond the bounds ``NAMED_ARCHIVES``
and ``NAMED_RANGES`` both sides are grouped by archive instead.

Defined results: a null html is an empty payload; a null url has the empty key. Pages of one
id and one payload are all responses. A null id is smaller than all others. Tables without
rows give no archives. A record is never cut: one larger than an archive's bound has an archive
of its own, and must fit into memory. Columns other than id, url and html are left out; their
names do not matter.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm.blocks import keep
from tripstrata.sources.workspace import new_folder

BLOCK_LINES = 3000
SHARD_LINES = 100_000
#: First and last keys of shards are held by the driver.
MAX_SHARDS = 100_000
#: An archive ends with the record that reaches one of these.
ARCHIVE_RECORDS, ARCHIVE_BYTES = 1000, 32 << 20
#: Archives that a lookup names to Spark one by one, and ranges that are broadcast (16 bytes each).
NAMED_ARCHIVES, NAMED_RANGES = 10_000, 1_000_000
DATE = "2000-01-01T00:00:00Z"
_CHUNK = 1 << 16
_PAGE = "urn:x-page:"


def reversed_host_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then port, path and query."""
    url = _header_value(url or "")
    found = re.match(r"(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^#]*)", url)
    if not found:
        return url
    host, port, rest = found.groups()
    labels = ",".join(reversed(host.lower().split(".")))
    return f"{labels}{'' if port in (None, ':80', ':443') else port}){rest or '/'}"


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), text)


def record(page_id, url: str | None, payload: bytes, refers_to=None, date: str = DATE) -> bytes:
    """One record as a gzip member. With ``refers_to`` it is a revisit without payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: <{_PAGE}{page_id}>",
        f"WARC-Date: {date}",
        *([] if url is None else [f"WARC-Target-URI: {_header_value(url)}"]),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: <{_PAGE}{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def parse(raw: bytes) -> dict:
    """Fields of one uncompressed record, with its HTTP header's length and its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"Content-Length: (\d+)", http)
    fields["payload"], fields["payload_bytes"] = payload, int(size[1])
    return fields


def _page(field: str | None) -> int | None:
    number = (field or "").strip("<>").removeprefix(_PAGE)
    return None if number in ("", "None") else int(number)


def members(raw: bytes):
    """Offset, length and content of every gzip member; zero bytes between them are padding."""
    view, at = memoryview(raw), 0
    while at < len(raw):
        if not raw[at]:
            at += 1
            continue
        unpack, begin, out = zlib.decompressobj(31), at, []
        while not unpack.eof:
            out.append(unpack.decompress(view[at : at + _CHUNK]))
            at = min(at + _CHUNK, len(raw)) - len(unpack.unused_data)
            if at >= len(raw) and not unpack.eof:
                raise ValueError("the archive ends inside a record")
        yield begin, at - begin, b"".join(out)


def write_archives(pages: DataFrame, folder: str, date: str = DATE) -> None:
    """Write a record for every page to archives of bounded bytes and records."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    marked = rows.select("page_id", F.sha1("html").alias("payload"))
    latest = marked.groupBy("payload").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")
    )
    # Not partitioned by the payload, so that a payload of many pages can be split.
    latest = latest.where("n > 1").drop("n").repartition(
        int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    refers = marked.join(latest, "payload").where("coalesce(page_id < refers_to, true)")
    refers = refers.where("refers_to is not null").select(
        F.col("page_id").alias("later"), F.col("payload").alias("same"), "refers_to"
    )

    def build(batches):
        task, nth, n, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to"))
            out, names = [], []
            for page_id, url, html, refers_to in zip(*columns):
                out.append(record(page_id, url, html.encode(), refers_to, date))
                names.append(f"w{task}-{nth}")
                n, size = n + 1, size + len(out[-1])
                if n >= ARCHIVE_RECORDS or size >= ARCHIVE_BYTES:
                    nth, n, size = nth + 1, 0, 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()), pa.array(names, pa.string())], ["value", "archive"]
            )

    # By the page, which is seldom repeated, so that the texts of a payload do not meet.
    told = rows.join(
        refers.distinct(),
        F.col("page_id").eqNullSafe(F.col("later")) & (F.sha1("html") == F.col("same")),
        "left",
    ).select("page_id", "url", "html", "refers_to")
    records = told.mapInArrow(build, "value binary, archive string")
    # Written byte for byte; the zero byte after each member is padding to gzip readers.
    records = records.select(F.col("value").cast("string"), "archive")
    records.write.option("lineSep", "\0").partitionBy("archive").text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    if "archive" not in files.columns:  # without archives Spark finds no column for their names
        files = files.where("false").withColumn("archive", F.lit(""))
    return files.select("archive", "content")


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """Key, page id and place of every record of the archives."""

    def scan(batches):
        for batch in batches:
            for name, raw in zip(batch["archive"].to_pylist(), batch["content"].to_pylist()):
                rows = []
                for offset, size, text in members(raw):
                    head = text[: text.index(b"\r\n\r\n")].decode()
                    fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
                    key = reversed_host_key(fields.get("WARC-Target-URI"))
                    rows.append((key, _page(fields["WARC-Record-ID"]), name, offset, size))
                columns = list(zip(*rows)) or [[]] * 5
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["key", "page_id", "archive", "place", "size"],
                )

    schema = "key string, page_id long, archive string, place long, size long"
    return _files(spark, folder).mapInArrow(scan, schema)


def build_index(found: DataFrame) -> DataFrame:
    """Compressed blocks of sorted captures, with the first and last key of each."""
    n = min(MAX_SHARDS, max(1, math.ceil(found.count() / SHARD_LINES)))
    n = max(n, min(MAX_SHARDS, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = found.repartitionByRange(n, "key", "page_id", "archive", "place")
    rows = rows.withColumn("shard", F.spark_partition_id())
    rows = rows.sortWithinPartitions("key", "page_id", "archive", "place")

    def pack(batches):
        held, shard = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) == BLOCK_LINES:
                    yield _block(shard, held)
                    held = []
                shard = row["shard"]
                held.append((row["key"], row["archive"], row["place"], row["size"]))
        if held:
            yield _block(shard, held)

    return rows.mapInArrow(
        pack, "shard int, first_key string, last_key string, block binary"
    )


def _block(shard: int, held: list[tuple]) -> pa.RecordBatch:
    lines = "\n".join("\t".join(map(str, h)) for h in held)  # keys hold no tab or line end
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int32()),
            pa.array([held[0][0]], pa.string()),
            pa.array([held[-1][0]], pa.string()),
            pa.array([zlib.compress(lines.encode())], pa.binary()),
        ],
        ["shard", "first_key", "last_key", "block"],
    )


def lookup(index: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Archives, offsets and lengths of all captures of the given URLs."""
    ends = index.groupBy("shard").agg(F.min("first_key"), F.max("last_key")).orderBy("shard")
    shards = [tuple(r) for r in ends.collect()]
    firsts, lasts = [s[1] for s in shards], [s[2] for s in shards]

    def route(batches):
        for batch in batches:
            keys = sorted({reversed_host_key(u) for u in batch["url"].to_pylist()})
            rows = []
            for key in keys:
                lo, hi = bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)
                rows += [(shards[i][0], key) for i in range(lo, hi)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())],
                ["shard", "key"],
            )

    asked = urls.select(F.col(url_col).cast("string").alias("url"))
    asked = asked.mapInArrow(route, "shard int, key string").distinct()

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = sorted(right.to_pylist(), key=lambda r: (r["first_key"], r["last_key"]))
        starts, stops = [b["first_key"] for b in blocks], [b["last_key"] for b in blocks]
        opened: dict[int, tuple[list, list]] = {}
        out = []
        for key in sorted(left["key"].to_pylist()):
            for i in range(bisect.bisect_left(stops, key), bisect.bisect_right(starts, key)):
                if i not in opened:
                    opened = {i: _open(blocks[i]["block"])}
                keys, lines = opened[i]
                out += lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
        return pa.table(
            {
                "archive": pa.array([r[1] for r in out], pa.string()),
                "place": pa.array([int(r[2]) for r in out], pa.int64()),
                "size": pa.array([int(r[3]) for r in out], pa.int64()),
            }
        )

    both = asked.groupBy("shard").cogroup(index.groupBy("shard"))
    return both.applyInArrow(search, "archive string, place long, size long")


def _open(block: bytes) -> tuple[list[str], list[list[str]]]:
    lines = [line.split("\t") for line in zlib.decompress(block).decode().split("\n")]
    return [line[0] for line in lines], lines


_FOUND = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, payload string"
)


def _cut(raw: bytes, places: list[int], sizes: list[int]) -> pa.RecordBatch:
    """The records at some ranges of an archive, their payload digests worked out again."""
    rows = []
    for place, size in zip(places, sizes):
        fields = parse(zlib.decompress(raw[place : place + size], 31))
        kind, said = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and digest(fields["payload"]) != said:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
        payload = fields["payload"].decode() if kind == "response" else None
        rows.append(
            (
                _page(fields["WARC-Record-ID"]),
                fields["payload_bytes"],
                said,
                kind,
                _page(fields.get("WARC-Refers-To")),
                fields.get("WARC-Target-URI"),
                payload,
            )
        )
    columns = list(zip(*rows)) or [[]] * 7
    names = [field.split(" ")[0] for field in _FOUND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def fetch(spark: SparkSession, folder: str, ranges: DataFrame) -> DataFrame:
    """The records at the given ranges."""
    ranges = keep(ranges, "ranges")
    n_ranges, n_archives = ranges.agg(F.count(F.lit(1)), F.count_distinct("archive")).first()
    files = _files(spark, folder)
    if n_archives <= NAMED_ARCHIVES:
        names = [row["archive"] for row in ranges.select("archive").distinct().collect()]
        files = files.where(F.col("archive").isin(names))
    if n_ranges > NAMED_RANGES:
        both = ranges.groupBy("archive").cogroup(files.groupBy("archive"))
        return both.applyInArrow(_cut_group, _FOUND)

    def cut(batches):
        for batch in batches:
            for raw, places, sizes in zip(*(batch[c] for c in ("content", "places", "sizes"))):
                yield _cut(raw.as_py(), places.as_py(), sizes.as_py())

    # At most NAMED_RANGES pairs of numbers; archives are read where they lie.
    spots = F.sort_array(F.collect_list(F.struct("place", "size")))
    by_archive = ranges.groupBy("archive").agg(spots.alias("spots"))
    told = files.join(F.broadcast(by_archive), "archive")
    cuts = told.select("content", F.col("spots.place").alias("places"), F.col("spots.size").alias("sizes"))
    return cuts.mapInArrow(cut, _FOUND)


def _cut_group(left: pa.Table, right: pa.Table) -> pa.Table:
    places, sizes = left["place"].to_pylist(), left["size"].to_pylist()
    cuts = [_cut(raw.as_py(), places, sizes) for raw in right["content"]]
    return pa.Table.from_batches(cuts or [_cut(b"", [], [])])


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, index them, look up every URL and read its records back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder)
    index = keep(build_index(keep(captures(spark, folder), "captures")), "capture-index")
    return fetch(spark, folder, lookup(index, pages.select("url")))
