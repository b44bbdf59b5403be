"""Quality scores on held-out labels, rule statistics against brute force, and learned lists."""

import re
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from tripstrata.llm import blocks, boosting, queries, rules

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = queries.op7_quality_classifier(spark, SF)
    assert rows.count() == 1000
    seen = rows.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in seen]) > 0.95
    good = [r for r in seen if r.quality == 1]
    assert sum(r.predicted == 1 for r in good) >= 0.98 * len(good)


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, " \n"), (2, "é" * 70_000)], "doc_id long, text string")
    none = spark.createDataFrame([(9, None, 0)], "doc_id long, quality int, toxic int")
    rows = boosting.quality_scores(docs, none, carry=True).collect()
    assert len(rows) == 4 and all(abs(r.score - 0.5) < 1e-3 for r in rows)
    assert boosting.quality_scores(docs.limit(0), none).count() == 0


def test_trees_learn_a_threshold():
    x = np.random.default_rng(0).random((800, 3)).astype(np.float32)
    y = ((x[:, 1] > 0.4) ^ (x[:, 2] > 0.7)).astype(float)
    trees = boosting.learn(x[:600], y[:600])
    assert ((trees.scores(x[600:]) >= 0.5) == (y[600:] == 1)).mean() > 0.95


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_rule_statistics(spark):
    odd = [None, "", " \t\n", "a b c d e " * 6, "x\r\nx\r\n\nx\n \n \n", "é\xa0 z\x85 " * 7 + "#*$%&|<>", "one two three four five six"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd)] + [(None, "q"), (3, odd[3])], "doc_id long, text string")
    docs = docs.unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    done, learned = rules.quality_rules(docs, labels)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted((tuple(r) for r in done.select("doc_id", *names).collect()), key=str)
    assert got == sorted(((r.doc_id, *base(r.text)) for r in docs.collect()), key=str)
    seen = done.join(labels, "doc_id").where("not base_failed").collect()
    assert learned and np.mean([r.kept == (r.quality == 1) for r in seen]) > 0.95
    assert done.where("base_failed and kept").count() == 0
    assert rules.quality_rules(docs.limit(0), labels)[0].count() == 0


def test_list_of_rules():
    blank = dict.fromkeys(rules.FEATURES, 0.0)
    rows = [blank | {"n_words": i % 37, "symbol_share": i % 11 / 10, "bad": i % 37 > 30 or i % 11 > 8} for i in range(1500)]
    found = rules.learn_list(rows)
    assert 2 <= len(found) <= 4
    for r in rows:
        assert any(all(c.holds(r) for c in rule) for rule in found) == r["bad"]
    assert rules.learn_list([blank | {"bad": False}] * 50) == rules.learn_list([]) == []


def test_the_sample_is_that_of_an_ordered_limit(spark):
    rows = spark.range(0, 3000, 1, 7).select((F.col("id") % 1500).alias("doc_id"), F.col("id").alias("x"))
    for n in (0, 1, 40, 700, 2999, 5000):
        want = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(n).collect()
        got = blocks.least_hashed(rows, "doc_id", n, ["x"])
        assert [(r.doc_id, r.x) for r in got] == [tuple(r) for r in want]
    one = rows.select(F.lit(7).alias("doc_id"), "x")
    assert len(blocks.least_hashed(one, "doc_id", 40, ["x"])) == 40
    assert blocks.least_hashed(rows.limit(0), "doc_id", 5, ["x"]) == []
