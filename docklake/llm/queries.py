"""The named queries of the training-data operators; each reads whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docklake.llm import (
    chunked_bpe, fill_middle, hard_negatives, language_model, neighbours, packing, pieces, pii, preference, quality, rules,
    simhash, toxicity,
)
from docklake.llm.common import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of four folds of five."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.trained_on(docs, labels, "quality", fold("doc_id", 5) != 0)
    return _predicted(docs, fold("doc_id", 5) == 0, quality.score(model), quality.ACCEPTED)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as tokens in sequences of 4096 at most."""
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of two folds of three."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.trained_on(docs, labels, "toxic", fold("doc_id", 3) != 1)
    return _predicted(docs, fold("doc_id", 3) == 1, toxicity.score(model), toxicity.REJECTED)


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2n (chosen) and 2n + 1 (rejected) as preference pairs."""
    turns = _table(spark, sf_dir, "conversations")
    pair = F.expr("conv_id div 2")
    return preference.preference_pairs(turns, pair, F.col("conv_id") % 2 == 0)


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document, learned from six folds of seven."""
    return language_model.scored(_table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)


def _predicted(docs: DataFrame, held_out: Column, score: Column, bound: float) -> DataFrame:
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= bound).cast("int"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and verdicts of the quality rules for every document."""
    entries = rules.ledger(_table(spark, sf_dir, "documents"))
    base_failed, kept = ~rules.passes(policy=1), rules.passes(policy=2)
    return entries.select("doc_id", *rules.MEASURES[:5], base_failed.alias("base_failed"), kept.alias("kept"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document: ids, length, check sum, scores and whether the ids decode to the text."""
    docs = _table(spark, sf_dir, "documents")
    return pieces.segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2, check=True)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for personal data, and how many values it had."""
    return pii.pseudonymised(_table(spark, sf_dir, "documents").select("doc_id", "text"), "corpus", count="n_values")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of near duplicates of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose id is divisible by 100, in a window below each of its positives."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label")
    return hard_negatives.mined(rows.withColumn("label", shifted_label()), F.col("vec_id") % 100 == 0)


def shifted_label() -> Column:
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-middle, as check sums of the output and of the text restored from it."""
    done = fill_middle.transformed(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2(F.encode("output", "utf-8"), 256).alias("output_sha256"), F.sha2(F.encode("restored", "utf-8"), 256).alias("restored_sha256"),
    )


def op13_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as ids and back, as check sums."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = chunked_bpe.encoded(_table(spark, sf_dir, "documents"), path, decode=True)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op10_language_model": op10_language_model,
    "op2_packing": op2_packing,
    "op8_preference": op8_preference,
    "op9_toxicity": op9_toxicity,
    "op3_neighbours": op3_neighbours,
    "op4_rules": op4_rules,
    "op5_pieces": op5_pieces,
    "op6_pii": op6_pii,
    "op7_simhash": op7_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_fill_middle": op12_fill_middle,
    "op13_chunked_bpe": op13_chunked_bpe,
}

ORACLES: dict[str, str] = {
    "op4_rules": rules.ORACLE,
    "op8_preference": preference.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_fill_middle": fill_middle.ORACLE,
}
