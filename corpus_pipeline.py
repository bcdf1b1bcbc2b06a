"""A training-data pipeline of five corpus operators.

``STAGES`` lists (name, function); each function takes the session, the
documents that its predecessor kept and the table directory, and returns a
DataFrame. All but the last return rows and columns of ``documents``; every
stage's result is written as Parquet and read again as the next one's input.

Nulls, empty texts, repeated rows and empty tables follow the operators: a
null text is an empty one (not toxic, not contaminated; empty texts are near
duplicates of each other, so one stays; it gets no bin). Of repeated rows one
stays after the near-duplicate stage. Columns beside those of ``documents``
are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, packing, quality, simhash, toxicity
from ledgerline.llm.common import table
from ledgerline.session import shared_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5."""
    grammar = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_column(F.col("text"), grammar) < 0.5)


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least 0.5."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = quality.score_columns(
        model, F.col("text"), F.col("lang"), F.col("source"), F.col("n_chars")
    )
    return docs.filter(score["score"] >= 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no 10-word window of a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece of a document, with its bin."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", reject_poor),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The learned stages can't be expressed in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    root = shared_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
