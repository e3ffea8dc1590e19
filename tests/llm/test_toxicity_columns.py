"""The toxicity stage sends every text to Python once."""

import fixtures_llm as fx
from pyspark.sql import functions as F

from tidemark.llm import toxicity


def test_one_copy_of_the_text_crosses(spark, monkeypatch):
    docs = spark.read.parquet(f"{fx.SF_DIR}/documents.parquet").withColumn("score", F.lit("kept")).limit(300)
    labels = spark.read.parquet(f"{fx.SF_DIR}/labels.parquet")
    seen, own = [], toxicity.feature_rows

    def watched(texts, *args, **kwargs):
        seen.append(texts.schema)
        return own(texts, *args, **kwargs)

    monkeypatch.setattr(toxicity, "feature_rows", watched)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert sum(f.dataType.simpleString().count("string") for f in seen[-1]) == sum(t == "string" for _, t in docs.dtypes)
    assert kept.exceptAll(docs).count() == 0 and kept.count() > 0
