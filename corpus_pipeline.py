"""From raw documents to a training mix: language, toxicity, near duplicates, benchmark text, source weights.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``documents``; the last returns the mix, one row a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm import decontaminate, jaccard, langid, mixing, toxicity
from ledgerlark.llm.common import is_remainder, reachable, written

LEAST_LANGUAGE_SCORE = 0.2  # a text of which no language holds a fifth of the n-grams is no prose


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters, or of no language, go."""
    judged = langid.identify(docs, is_remainder(F.col("doc_id"), 4, 2))
    kept = judged.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select("doc.*")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score_toxicity(docs, labels, is_remainder(F.col("doc_id"), 3, 1))
    return scored.filter("predicted = 0").select("doc.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return jaccard.near_duplicates(docs, n=5, percent=80, keep=docs.columns, kept_only=True).select("doc.*")


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.contamination(docs, bench, keep=docs.columns).filter("n_hit = 0").select("doc.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; documents it leaves out have 0."""
    mix = mixing.mix_sources(docs.select("doc_id", "source", "text"))
    return mix.select("doc.doc_id", "doc.source", "size", "source_size", "target", "taken")


STAGES = [
    ("language", language), ("toxicity", clean), ("near duplicates", distinct), ("benchmark", unseen), ("mix", mixed)
]

# The first two stages decide by trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as a table and read again."""
    docs = reachable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
