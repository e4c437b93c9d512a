"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, dedup, langid, pii, quality_model, quality_rules, sharding
from .common import crc_mod, table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document; the one whose id names the class is kept."""
    found = dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; the model knows no label of fold 2."""
    docs, fold = table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 4)
    model = quality_model.fit(docs.where(fold != 2), table(spark, sf_dir, "labels").where(fold != 2))
    return quality_model.score(docs, model).select("doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, log-likelihood ratio and verdict of every document; documents labelled good are the trusted target."""
    labels = table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return quality_rules.score(table(spark, sf_dir, "documents"), labels)


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), bpe.tokenizer_path())


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards, and their shard if there were 41."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every section of every document."""
    return bpe.section_token_counts(table(spark, sf_dir, "documents"), bpe.tokenizer_path())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the model knows only folds 0 and 2."""
    docs = table(spark, sf_dir, "documents")
    fold = crc_mod(F.col("doc_id"), 3)
    model = langid.fit(docs.where(fold != 1))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or its passages, with the item and the share of it."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in reply order, without quotes."""
    return chat.link(table(spark, sf_dir, "conversations"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_quality_model, op3_quality_rules, op4_bpe_roundtrip, op5_jump_shards, op6_token_counts, op7_language_id, op8_decontamination, op9_quotation_links, op10_personal_data)}
ORACLES: dict[str, str] = {"op5_jump_shards": sharding.oracle()}
