"""Clean a corpus in five stages, each of which rereads what the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. Texts and rows are dropped by a stage's own decision only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm import bpe, boosting, decontam, jaccard, substrings
from tripstrata.llm.queries import TOKENIZERS
from tripstrata.sources.workspace import new_folder

#: Near duplicates of the pipeline: shingles of five words, similarity of at least 0.8.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = boosting.quality_scores(docs, labels, carry=True)
    return scored.where("predicted = 1").select("rest.*").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id."""
    grouped = jaccard.similarity_components(docs, SHINGLE, PERCENT, carry=True)
    return _columns(grouped.where("keeper or n_shingles = 0"), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that also start earlier; those left empty by it go."""
    done = substrings.remove_repeats(docs, carry=True)
    kept = done.where("n_removed = 0 or n_removed < n_words")
    return _columns(kept, docs, n_chars=F.length("text").cast("long"))


def _columns(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs``, from ``rest`` but for the id, the text and new ones."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), **new}
    return rows.select(*(own.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))


def leaked_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; a few words that are one are no leak."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kinds = [kind for kind in decontam.KINDS if kind != "short"]
    leaks = decontam.find_leaks(docs, benchmark, kinds=kinds).select("row_key").distinct()
    # The documents' own columns may have any names, that of the key among them.
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own")
    keyed = docs.select(own, decontam.row_key("doc_id", "text").alias("row_key"))
    return keyed.join(leaks, "row_key", "left_anti").select("own.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    done = bpe.encode_and_decode(docs, f"{TOKENIZERS}/byte_bpe_50k.json")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("leaked_benchmarks", leaked_benchmarks),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"stage-{name.replace('_', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
