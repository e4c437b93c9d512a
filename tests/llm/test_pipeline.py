"""The pipeline against its stages' plain meaning, on the smallest tables."""

from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import bpe

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF).toPandas()
    c = bpe.codec(open(bpe.tokenizer_path()).read())
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.doc_id.is_unique and 0.7 * len(texts) < len(got) <= len(set(texts.values()))
    assert got.round_trip.all()
    same = [list(r.token_ids) == c.encode(texts[r.doc_id]) for r in got.itertuples()]
    assert sum(same) > 0.9 * len(same)  # the others had personal data


def test_stages_take_nulls_and_nothing(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "some plain words that stay as they are", "en", "s", 38), (3, "some plain words that stay as they are", "en", "s", 38)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for some in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, SF)
            assert name == "tokens" or out.columns == some.columns
            assert out.count() <= some.count()
    assert corpus_pipeline.without_personal_data(spark, docs, SF).where(F.col("text").isNull()).count() == 1
