"""Exact deduplication: frequent digests are settled where they lie, the others by an ordinary shuffle.

Texts are compared by the SHA-256 of the text with A-Z in lower case. The digests are stored once; all later steps
read them instead of the texts. A Misra-Gries sketch of the digests (Spark's frequent-items state, one for each task,
merged in two levels) names every digest that more than ``2 * 3.5 / 4096`` of the rows share, and perhaps some
others: 1,000 at most, so what follows may be broadcast. A sketch counts too low, so a second pass counts its candidates
exactly and finds the row of each that stays (partial aggregates only, as many rows as candidates a task). These
verified winners are broadcast: every row of a frequent digest gets its answer, or goes, without leaving its task. The
digests that remain have no frequent key and are shuffled by digest.

Everything is DataFrame operations; no Python runs in tasks.

Defined cases: a NULL text is the empty text; of equal texts the row with the largest id stays, a NULL id counting as
the least; of rows that agree in id and text one stays; texts of any length; extra columns are ignored by ``find_copies``
and returned as they were by ``drop_copies``, also where names repeat; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, only, prepare

# Counters of a sketch and answers taken from it. 2,000 counters need a table of 4,096 places, and its error is at
# most 3.5 / 4,096 of the rows; an answer is certain from twice the error on, so fewer than 600 digests are certain.
TRACKED, CANDIDATES = 2_000, 1_000
# Sketches are merged in groups of tasks first, then those of the groups.
GROUPS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(text: Column) -> Column:
    """A-Z in lower case and nothing else. For ASCII texts the built-in ``lower`` is the same and works on bytes."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest(text: Column) -> Column:
    return F.sha2(normal(text), 256)


def frequent(digests: DataFrame) -> DataFrame:
    """``text_sha256`` of at most ``CANDIDATES`` digests, among them all that are certainly frequent."""
    sketch = (
        digests.select("text_sha256", F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("lot"))
        .groupBy("lot").agg(F.expr(f"approx_top_k_accumulate(text_sha256, {TRACKED})").alias("state"))
        # Grouped, so that no rows give no state instead of an error.
        .select("state", F.lit(0).alias("all")).groupBy("all").agg(F.expr(f"approx_top_k_combine(state, {TRACKED})").alias("state"))
    )
    found = sketch.select(F.explode(F.expr(f"approx_top_k_estimate(state, {CANDIDATES})")).alias("top"))
    return found.filter(F.col("top.count") > 1).select(F.col("top.item").alias("text_sha256"))


def groups_of(digests: DataFrame) -> DataFrame:
    """``text_sha256, group_size, stays``: the row that stays is the greatest (id, row number)."""
    return digests.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays"))


def winners_of(digests: DataFrame) -> DataFrame:
    """The groups of frequent digests, counted exactly and stored: at most ``CANDIDATES`` rows."""
    names = materialize(frequent(digests), "frequent")
    return materialize(groups_of(digests.join(F.broadcast(names), "text_sha256", "left_semi")), "winners")


def find_copies(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    prepare(docs.sparkSession)
    digests = materialize(
        only(docs, "doc_id", "text").select(
            F.col("doc_id").cast("long"), digest(F.col("text")).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row")), "digests")
    winners = F.broadcast(winners_of(digests))
    settled = digests.join(winners, "text_sha256")
    others = digests.join(winners, "text_sha256", "left_anti")
    shuffled = others.join(groups_of(others), "text_sha256")
    return settled.unionByName(shuffled).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts.

    Rows of frequent digests whose id is not the one that stays go where they lie. For the rest Spark keeps one
    row of a digest a task before the shuffle.
    """
    prepare(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    doc_id, text = F.col(names[docs.columns.index("doc_id")]).cast("long"), F.col(names[docs.columns.index("text")])
    digests = materialize(rows.select(doc_id.alias("doc_id"), digest(text).alias("text_sha256"),
                                      F.lit(0).alias("row")), "digests")
    stays = winners_of(digests).select("text_sha256", F.col("stays.doc_id").alias("keep_id"))
    marked = rows.withColumn("text_sha256", digest(text)).join(F.broadcast(stays), "text_sha256", "left")
    left = marked.filter(F.col("keep_id").isNull() | (doc_id == F.col("keep_id")))
    along = Window.partitionBy("text_sha256").orderBy(doc_id.desc_nulls_last(), text)
    kept = left.withColumn("rank", F.row_number().over(along)).filter("rank = 1")
    return kept.select(*[F.col(n) for n in names]).toDF(*docs.columns)
