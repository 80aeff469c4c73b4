"""A corpus pipeline of five stages over ``documents``: quality, toxicity, near duplicates, secrets, packing.

Each stage takes what its predecessor kept. The first four return the columns of ``documents``:
the filters drop rows, and the scan for secrets replaces what it finds in the texts. The last one
returns the places of all texts in packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlelake.llm import packing, quality, secrets, simhash, toxicity
from candlelake.session import shared_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier does not reject."""
    return quality.keep_good(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold for toxicity."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kinds, and ``n_chars`` as it is then."""
    return secrets.redact(docs, count_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All words of all documents, dealt to sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Fitted classifiers, fingerprints and bin packing have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
