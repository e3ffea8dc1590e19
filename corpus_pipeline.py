"""A corpus pipeline over ``documents``: toxic texts go, repeated lines go, one of each group of near-duplicates
stays, contaminated documents go, and what is left is encoded and decoded.

Defined cases, in all stages: a NULL text stays NULL (it is scored, encoded and counted as the empty text, holds no item and is
like no other text); a row with a NULL id is judged by its text where a stage looks at one row, is like no other
document, and goes with all rows without an id where one of them holds an item; repeated rows are judged alike, and those
with the least id of their class stay; texts of any length; columns that ``documents`` does not have are ignored,
also where their names clash; empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontamination, line_dedup, near_dedup, toxicity
from tidemark.llm.common import only, prepare, scratch_root

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of documents in ``docs``."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(only(docs, *COLUMNS), labels)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated lines; ``n_chars`` follows the text."""
    rows = only(docs, *COLUMNS)
    kept = line_dedup.drop_repeated_lines(rows)
    return kept.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup.keep_one(only(docs, *COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(only(docs, *COLUMNS), benchmark)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of what they decode to."""
    return bpe.round_trip_digests(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]

# The classifier and the signatures have no SQL form; tests/llm/test_pipeline_llm.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared scratch folder and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
