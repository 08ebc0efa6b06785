"""From raw documents to packed training sequences: quality, toxicity, near duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and, but for the last, returns the
columns of ``docs``. Labels come from the tables in ``sf_dir``. Null and empty texts are scored, compared and packed like
any other text; all empty texts are copies of each other, so one of those that pass the first two stages stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docklake.llm import packing, pii, quality, similar, toxicity
from docklake.llm.common import fold, stored

PSEUDONYM_KEY = "corpus"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from four folds of five of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.trained_on(docs, labels, "quality", fold("doc_id", 5) != 0)
    return docs.where(quality.score(model) >= quality.ACCEPTED)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models don't reject; they learn from two folds of three of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.trained_on(docs, labels, "toxic", fold("doc_id", 3) != 1)
    return docs.where(toxicity.score(model) < toxicity.REJECTED)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, a similarity of 0.8 or more."""
    return similar.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; ``n_chars`` follows the text."""
    done = pii.pseudonymised(docs, PSEUDONYM_KEY)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("simhash near-dedup", without_copies),
    ("pii", without_personal_data),
    ("best-fit packing", in_sequences),
]

ORACLE_SQL = None  # trained models, fingerprints and tokenizers; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
