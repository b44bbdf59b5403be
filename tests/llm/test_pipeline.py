"""Stages of the pipeline."""

import corpus_pipeline
import __spark_entry__ as registry
from tripstrata.llm import jaccard

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert out.columns == columns and 0 < len(rows) <= before, name
        assert all(r.n_chars == len(r.text) for r in rows)
        docs, before = spark.createDataFrame(rows, docs.schema), len(rows)
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert tokens.columns == ["doc_id", "n_tokens", "ids"] and tokens.count() == before
    assert registry.queries()["pipeline"](spark, SF).count() == before


def test_near_duplicates_keep_one_and_empties(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (1, text + " x"), (2, "other words only in this text here"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 5, 6]
    assert jaccard.PERCENT == 90


def test_leaks_go_by_row(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, item), (None, "clean words"), (1, item), (1, "other clean words"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.leaked_benchmarks(spark, docs, SF).collect()
    assert sorted(map(tuple, kept), key=str) == [(1, "other clean words"), (2, None), (None, "clean words")]
