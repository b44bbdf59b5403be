"""Benchmark items planted in texts, exactly and with exchanged slots."""

import random
import re

from pyspark.sql import functions as F

from tripstrata.llm import decontam, queries

ITEM = "A train with Anna leaves Berlin at 9 and runs 80 km until Anna meets Bob after 80 km of track"


def test_planted_items(spark):
    filler = "some other words stand here around it "
    changed = ITEM.replace("Anna", "Eve").replace("80", "95").replace("Berlin", "Rome").replace("km", "miles")
    broken = ITEM.replace("Anna", "Eve", 1)
    rows = [
        (1, filler + ITEM + " " + filler),
        (2, filler.strip() + ". " + changed + ", " + filler),
        (3, filler + broken),
        (4, filler * 9),
        (5, None),
        (6, ""),
        (None, ITEM),
        (7, " ".join(ITEM.split()[:9])),
        (8, "1 2 3 4 5 6 7 8 9 " * 5),
        (8, ITEM.replace(" ", "\n\t")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = [(11, ITEM), (12, None), (13, ""), (14, "1 2 3 4 5 6 7 8"), (15, "unseen words of another item only here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_leaks(docs, benchmark).collect()
    assert sorted(((r.doc_id, r.item_id, r.kind) for r in got), key=str) == [
        (1, 11, "exact"), (2, 11, "changed"), (8, 11, "exact"), (None, 11, "exact"),
    ]
    assert decontam.find_leaks(docs.limit(0), benchmark).count() == 0
    assert decontam.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_query_finds_every_whole_copy(spark):
    sf = "/root/testdata/sf0.01"
    squeeze = lambda t: re.sub(r"[^\w]+", " ", t or "").lower()
    docs = {r.doc_id: squeeze(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: squeeze(r.text).strip() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    copies = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = queries.op10_benchmark_decontamination(spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got} == copies


def _found(spark, texts, items, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontam.find_leaks(docs, benchmark, **more).collect()
    return {(r.doc_id, r.item_id): r.kind for r in got}


def test_edits_that_change_the_number_of_words(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    short, long = words[:15], words[30:89]
    items = [" ".join(short), " ".join(long), "we went by the slow train to Rome and then ate 80 small cakes with all our old friends"]
    texts = [
        " ".join(["so", *short[:7], "other", *short[8:], "so"]),
        " ".join(["so", *long[:29], "more", *long[29:], "so"]),
        " ".join(["so", *long[:29], *long[30:], "so"]),
        "so " + items[2].replace("Rome", "New York"),
        "so " + items[2].replace("80", "80 thousand"),
        " ".join(["so", *long[:20], "so"]),
    ]
    got = _found(spark, texts, items)
    assert set(got) == {(0, 0), (1, 1), (2, 1), (3, 2), (4, 2)}
    assert got[3, 2] == "changed" and got[4, 2] == "exact"


def test_items_without_template_windows(spark):
    items = ["What is 7 times 8", "The Old Man And The Sea By Ernest Hemingway", "12 + 30 = 42 and 1 2 3", "Why so", ITEM]
    texts = [
        "He said: what is 7 times 8?",
        "read The Old Man And The Sea By Ernest Hemingway, soon",
        "solve 12 + 30 = 42 and 1 2 3 now",
        "but why so?",
        "some text " + ITEM.upper(),
        "some text " + ITEM.lower() + " more",
        "what is 7 times 9 and why is it so",
    ]
    assert set(_found(spark, texts, items, kinds=decontam.KINDS)) == {
        *((i, min(i, 4)) for i in range(6)), (6, 0)
    }


def test_slots_that_do_not_hold_together(spark):
    fruit = "A boy has 2 apples and 2 pears and asks how many fruits he has in all"
    few = "of 2 or 2 or 2 or 2 or"
    texts = [
        "so " + ITEM.replace("Anna", "Eve", 1),
        "so " + fruit.replace("2 apples", "3 apples").replace("2 pears", "5 pears"),
        "so of 3 or 4 or 5 or 6 or",
    ]
    assert {k for k in _found(spark, texts, [ITEM, fruit, few])} == set()
    got = _found(spark, texts, [ITEM, fruit, few], kinds=("exact", "changed", "mixed"))
    assert got == {(0, 0): "mixed", (1, 1): "mixed"}
    assert set(_found(spark, texts, [ITEM, fruit, few], kinds=decontam.KINDS)) == {(0, 0), (1, 1)}


def test_items_of_few_words_are_told_apart(spark):
    docs = spark.createDataFrame([(n, f"the text {n} is about the sea") for n in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "about the sea"), (3, ""), (4, None)], "item_id long, text string")
    assert decontam.find_leaks(docs, items).count() == 0
    assert decontam.find_leaks(docs, items, kinds=decontam.KINDS[:4]).count() == 0
    told = decontam.find_leaks(docs, items, kinds=decontam.KINDS).collect()
    assert {(r.item_id, r.kind) for r in told} == {(1, "short"), (2, "short")} and len(told) == 40


def test_windows_hash_as_their_slices_without_one(spark):
    rows = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],), (None,), (["é", "", "x"],)], "w array<string>")
    for n in (1, 2, 3):
        found = rows.select("w", decontam.window_hashes(F.col("w"), n, F.lit("tag")).alias("h"))
        assert "slice(" not in found._jdf.queryExecution().optimizedPlan().toString()
        at = F.sequence(F.lit(1), F.size("w") - (n - 1))
        plain = F.transform(at, lambda i: F.xxhash64(F.slice("w", i, n), F.lit("tag")))
        plain = F.when(F.size("w") >= n, plain)
        assert found.where(~F.col("h").eqNullSafe(plain)).count() == 0


def test_patterns_cut_words_as_the_plain_ones(spark):
    pick = random.Random(4)
    signs = [*"aAÉß𐐀 .,;:!?\"'()[]09-$%/ \t\n\r\x0b\x85  <=>", "<name>=", " kg ", "5 ", ". "]
    texts = [("".join(pick.choice(signs) for _ in range(pick.randint(0, 40))),) for _ in range(4000)]
    mark = r"[.,;:!?\"'()\[\]]+"
    plain = F.regexp_replace("text", r"[ \t\n\x0B\f\r]+", " ")
    plain = F.regexp_replace(plain, rf"(?:^|(?<= )){mark}|{mark}(?= |$)", "")
    plain = F.filter(F.split(F.lower(plain), " +"), lambda w: w != "")
    rows = spark.createDataFrame(texts, "text string")
    assert rows.where(~decontam.words_of(F.col("text")).eqNullSafe(plain)).count() == 0
