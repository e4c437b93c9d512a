"""Corpus pipeline: language ID, near-duplicates, benchmark decontamination, personal data and tokens, applied to `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of the
next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, decontaminate, dedup, langid, pii
from skyledger.llm.common import table, written

#: A document whose largest language has less than this share of its letters' trigrams is rejected, as one without letters is.
LEAST_SHARE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a known language; the model learns from the languages that docs name."""
    judged = langid.predict(docs, langid.fit(docs))
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return dedup.deduplicated(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of every document, with their number."""
    path = bpe.tokenizer_path()
    encoded = bpe.encode_decode(docs, path)
    exact = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return encoded.select("doc_id", "lang", "source", "token_ids", F.size("token_ids").cast("bigint").alias("n_tokens"), exact.alias("round_trip"))


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", tokens),
]
#: Mixture inference and sketches can't be expressed in SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
