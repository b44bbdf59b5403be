"""BPE and token files against the public library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tripstrata.llm import bpe, queries, tokenfile

BYTE = f"{queries.TOKENIZERS}/byte_bpe_50k.json"
WORD = f"{queries.TOKENIZERS}/word_bpe_49k.json"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    letters = "aabcdeté'’ \n\t.,!?0123ABCøπ中́\xa0ÀßµSsTt"
    texts = ["", "a<|endoftext|>b <|startoftext|>", "  x \n\n y", "a" * 3000, "日本語 it’s “q”", "é é\x85\x1c z"]
    return texts + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(600)]


def test_bpe_equals_the_library(odd_texts):
    library, mine = Tokenizer.from_file(BYTE), bpe.encoder(BYTE)
    for text in odd_texts:
        ids = np.frombuffer(mine.encode(text), "<i4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        said = library.decode(ids.tolist(), skip_special_tokens=False)
        assert mine.decode(ids).decode("utf-8", "replace") == said


def test_words_equal_the_library(odd_texts):
    library, mine = Tokenizer.from_file(WORD), tokenfile.word_encoder(WORD)
    for text in odd_texts:
        ids = np.frombuffer(mine.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_segment_gives_any_id():
    rng = np.random.default_rng(2)
    ids = rng.choice([0, 1, 255, 256, 70_000, 2**31], 5000).astype(np.uint32)
    found = tokenfile.Segment(tokenfile.segment(3, 1, [4, 9], [ids[:2000], ids[2000:]]))
    assert (found.all() == ids).all()
    assert [found.get(i) for i in range(0, 5000, 7)] == ids[::7].tolist()
    assert (found.shard, found.number, found.ends.tolist()) == (3, 1, [2000, 5000])


def test_queries_equal_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    for name, path in (("op6_bpe_encode_decode", BYTE), ("op9_token_output", WORD)):
        library, expected, start = Tokenizer.from_file(path), [], 0
        for d in docs:
            ids = library.encode(d.text or "", add_special_tokens=False).ids
            if path == BYTE:
                said = library.decode(ids, skip_special_tokens=False)
                texts = ",".join(map(str, ids)), said
                expected.append((d.doc_id, len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts)))
            else:
                ids.append(1)
                crc = zlib.crc32(np.array(ids, "<u4").tobytes())
                expected.append((d.doc_id, start, len(ids), crc))
                start += len(ids)
        assert sorted(map(tuple, queries.QUERIES[name](spark, SF).collect())) == expected


def test_memory_of_encoding_is_bounded_and_goes_before_writing(monkeypatch):
    monkeypatch.setattr(tokenfile, "REMEMBERED", 100)
    mine = tokenfile.word_encoder(WORD)
    for n in range(200):
        mine.encode(f"w{n}a w{n}b")
    assert len(mine.words) <= 106
    taken = []
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 40)
    parts = bpe.small_parts

    def counted(batch, column):
        for part in parts(batch, column):
            taken.append(len(part))
            yield part

    monkeypatch.setattr(tokenfile, "small_parts", counted)
    rows = [np.array([n, 1], "<u4") for n in range(30)]
    planes = [r.view(np.uint8).reshape(-1, 4).T.tobytes() for r in rows]
    batch = pa.RecordBatch.from_pydict({"shard": [0] * 30, "doc_id": [*range(30)], "planes": planes})
    files = [tokenfile.Segment(b["value"][0].as_py()) for b in tokenfile._segments([batch], 20)]
    assert tokenfile.word_encoder.cache_info().currsize == 0
    assert sum(taken) == 30 and max(taken) < 10
    assert [len(f.ends) for f in files] == [10, 10, 10]
    assert np.concatenate([f.all() for f in files]).tolist() == np.concatenate(rows).tolist()


def test_nulls_ties_and_no_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "SHARD_BYTES", 8)
    monkeypatch.setattr(tokenfile, "SEGMENT_IDS", 4)
    rows = [(5, "one two"), (None, "x"), (2, None), (5, "a"), (2, ""), (9, "word " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokenfile.write_tokens(docs, WORD, f"{tmp_path}/a")
    got = [tuple(r)[:3] for r in tokenfile.read_tokens(spark, f"{tmp_path}/a").orderBy("start").collect()]
    assert [g[0] for g in got] == [None, 2, 2, 5, 5, 9]
    assert [g[1] for g in got] == np.cumsum([0, *(g[2] for g in got)])[:-1].tolist()
    tokenfile.write_tokens(docs.limit(0), WORD, f"{tmp_path}/b")
    assert tokenfile.read_tokens(spark, f"{tmp_path}/b").count() == 0
    done = bpe.encode_and_decode(docs, BYTE, carry=True).collect()
    assert sorted((r.decoded, r.rest.text or "") for r in done) == sorted(((t or ""),) * 2 for _, t in rows)
