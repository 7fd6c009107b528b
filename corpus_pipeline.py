"""Corpus pipeline over documents: quality, near-dedup, decontamination, PII surrogates, SentencePiece ids.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and its decisions take effect;
all but the last return the columns of documents. The result is written as Parquet and read again between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gneiss.llm import decontamination, near_dedup, pieces, quality, surrogates
from gneiss.session import materialize, ship, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship(spark)
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id (five-word shingles, similarity of 0.8)."""
    ship(spark)
    return near_dedup.dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities in texts are replaced; n_chars follows the new text."""
    from pyspark.sql import functions as F

    ship(spark)
    return surrogates.replace_pii(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text stays beside its ids, score and runners-up."""
    ship(spark)
    return pieces.encode_column(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII surrogates", pii_surrogates),
    ("SentencePiece encoding", sentencepiece_ids),
]

#: The classifier, the surrogates and the encoder cannot be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
