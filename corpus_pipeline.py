"""A corpus made ready for training: each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import decontaminate, line_dedup, near_dup, pieces, quality_rules
from martflow.llm.common import materialize, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id has; ``n_chars`` follows the text."""
    done = line_dedup.replace_text(docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.kept_documents(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; those stay as they are."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, little-endian 32-bit, with the checks of the encoding."""
    done = pieces.checked(docs, keep=["doc_id", "lang", "source"], into="coded")
    return done.select("doc_id", "lang", "source", "coded.*")


STAGES = [
    ("quality rules", rules),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", clean),
    ("SentencePiece encoding and decoding", tokens),
]

# The last stage encodes with a fixed vocabulary, which SQL cannot express; a test uses brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; every result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
