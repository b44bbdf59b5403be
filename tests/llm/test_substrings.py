"""Repeated passages against a brute-force search."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.patterns import one_words, paired
from tripstrata.llm import substrings


def brute(rows, window):
    words = [(i, d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (d, t) in enumerate(rows)]
    seen = {}
    place = lambda d, s: (d is not None, d or 0, s)
    for _, d, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            seen[key] = min(seen.get(key, place(d, s)), place(d, s))
    out = []
    for _, d, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] < place(d, s):
                gone[s : s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, **options):
    rows = substrings.remove_repeats(docs, **options)
    rows = rows.select("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "ab", "é", "x,", "the", "of", "zz", "B", "b"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 160))] for _ in range(40)]
    rows = []
    for i in range(150):
        kind = rng.random()
        if kind < 0.25:
            w = list(rng.choice(base))
        elif kind < 0.6:
            a, b = rng.choice(base), rng.choice(base)
            w = a[rng.randint(0, 30) :] + ["q"] + b[: rng.randint(0, 90)]
        elif kind < 0.7:
            w = ["same"] * rng.randint(0, 70)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice([" ", "  ", "\n", "\t"]).join(w)))
    rows += [(200, None), (201, ""), (None, rows[3][1]), (3, rows[3][1]), (202, "\xa0 x"), (3, rows[3][1])]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for window, first in ((20, 5), (6, 3), (5, 5)):
        assert found(docs, window=window, first=first) == brute(rows, window)


def test_other_columns_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(1, text, 7, "u"), (2, text, 8, None)], "doc_id long, text string, block int, row_id string"
    )
    rows = substrings.remove_repeats(docs, carry=True).select("doc_id", "n_removed", "rest.block", "rest.row_id")
    assert sorted(map(tuple, rows.collect())) == [(1, 0, 7, "u"), (2, 30, 8, None)]
    assert substrings.remove_repeats(docs.where(F.lit(False))).count() == 0


def test_texts_that_weak_hashes_confuse(spark):
    """No window of either text occurs in the other; nor do words that only look alike."""
    one, other = paired()
    x, y = one_words()
    rows = [(1, " ".join(one)), (2, " ".join(other)), (3, " ".join(one[:300]))]
    rows += [(4, " ".join([x, *"cdefghijklmnopqrstuvw"])), (5, " ".join([y, *"cdefghijklmnopqrstuvw"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20)


def test_one_very_long_text(spark):
    words = [f"w{i % 50_000}" for i in range(120_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "x " * 10)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect()}
    assert got == {1: (120_000, 70_000), 2: (10, 0)}
