"""Archives written, indexed and read back."""

import base64
import gzip
import hashlib
import re
from pathlib import Path

from tripstrata.llm import queries, warc


def expected(rows):
    latest = {}
    for p, _, h in rows:
        latest.setdefault(h or "", []).append(p)
    out = []
    for p, _, h in rows:
        ids = [i for i in latest[h or ""] if i is not None]
        top = max(ids, default=None)
        revisit = top is not None and p != top
        raw = (h or "").encode()
        said = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((p, len(raw), said, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.op1_warc_index(spark, sf).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_nulls_ties_and_odd_pages(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.example.org/{i % 4}", "same" if i % 2 else f"p{i}\r\n\r\nx") for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (None, "http://a b/\n\t%41", "null id"), (None, "x", "same")]
    rows += [(102, "http://u:p@HOST.example.org:8080/a?b#c", "é" * 300_000), (102, "http://z/", "tie"), (102, "http://z/", "tie")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    assert sorted((tuple(r)[:5] for r in warc.archive_and_read(pages).collect()), key=str) == expected(rows)
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_files_are_plain_gzip_and_lookups_are_exact(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://e.org/{i % 5}", f"<p>{i}") for i in range(20)], "page_id long, url string, html string")
    folder = f"{tmp_path}/w"
    warc.write_archives(pages, folder)
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in Path(folder).rglob("part-*"))
    assert whole.count(b"WARC/1.1\r\n") == 20
    index = warc.build_index(warc.captures(spark, folder))
    urls = spark.createDataFrame([("http://E.org/3",), ("http://none.org/",)], "url string")
    found = warc.fetch(spark, folder, warc.lookup(index, urls)).collect()
    assert sorted((r.page_id, r.payload) for r in found) == [(i, f"<p>{i}") for i in (13, 18, 3, 8)][2:] + [(13, "<p>13"), (18, "<p>18")]


def test_keys():
    assert warc.reversed_host_key("https://www.Example.com:443/a?b#c") == "com,example,www)/a?b"
    assert warc.reversed_host_key("http://u@h.org:81") == "org,h:81)/"
    assert warc.reversed_host_key(None) == ""


def test_lookups_open_the_archives_they_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 3)
    rows = [(i, f"http://e.org/{i}", f"<p>{i}" * 50, "x") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive string").repartition(2)
    folder = f"{tmp_path}/w"
    warc.write_archives(pages, folder)
    archives = {f.parent.name for f in Path(folder).rglob("part-*")}
    assert len(archives) >= 14
    index = warc.build_index(warc.captures(spark, folder)).cache()
    one = warc.fetch(spark, folder, warc.lookup(index, pages.where("page_id = 7").select("url")))
    assert [(r.page_id, r.payload) for r in one.collect()] == [(7, "<p>7" * 50)]
    # Spark lists the folders of other archives, but reads none of them.
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"w\d+-\d+", re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]))) == 1
    # Ranges and archives beyond the bounds give the same.
    monkeypatch.setattr(warc, "NAMED_RANGES", 5)
    monkeypatch.setattr(warc, "NAMED_ARCHIVES", 2)
    found = warc.fetch(spark, folder, warc.lookup(index, pages.select("url"))).collect()
    assert sorted((r.page_id, r.payload) for r in found) == [(i, h) for i, _, h, _ in rows]


def test_archives_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    texts = [hashlib.sha512(str(i).encode()).hexdigest() * (9 if i == 4 else 2) for i in range(30)]
    pages = spark.createDataFrame([(i, "http://e.org/", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    folder = f"{tmp_path}/w"
    warc.write_archives(pages.coalesce(1), folder)
    sizes = [f.stat().st_size for f in Path(folder).rglob("part-*")]
    assert len(sizes) > 3 and max(sizes) < 2000 + 1000
