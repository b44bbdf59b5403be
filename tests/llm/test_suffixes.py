"""Repeated byte strings against a brute-force search."""

import hashlib
import random

from tests.llm.patterns import paired
from tripstrata.llm import blocks
from tripstrata.llm import suffixes


def brute(rows, length=50):
    least = {}
    key = lambda d: (d is not None, d or 0)
    for d, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            least[w] = min(least.get(w, key(d)), key(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if least[b[s : s + length]] < key(d):
                gone[s : s + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted_rows(seed=7, n=120):
    rng = random.Random(seed)
    letters = "abcé \n"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(25)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.2:
            t = rng.choice(base)
        elif kind < 0.7:
            a, b = rng.choice(base), rng.choice(base)
            t = a[rng.randint(0, 80) :] + "Q" * rng.randint(0, 3) + b[: rng.randint(0, 200)]
        elif kind < 0.8:
            t = "ab" * rng.randint(0, 90)
        else:
            t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))
        rows.append((i, t))
    rows += [(500, None), (501, ""), (None, rows[3][1]), (3, rows[3][1]), (502, rows[9][1] + "z")]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = planted_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    done = suffixes.remove_repeated_bytes(docs).drop("kept")
    assert sorted((tuple(r) for r in done.collect()), key=str) == brute(rows)
    assert suffixes.remove_repeated_bytes(docs.limit(0)).count() == 0


def test_texts_that_weak_hashes_confuse(spark):
    """No 50 bytes of either text occur in the other."""
    one, other = ("".join(t) for t in paired())
    rows = [(1, one), (2, other), (3, one), (4, other[:200])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    done = suffixes.remove_repeated_bytes(docs)
    got = done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_kept_tables_take_zstd(spark):
    rows = spark.range(20).selectExpr("id doc_id", "'some text' text")
    for table in (blocks.store(rows, 2), blocks.keep(rows, "rows")):
        assert table.count() == 20 and all(".zstd." in f for f in table.inputFiles())
