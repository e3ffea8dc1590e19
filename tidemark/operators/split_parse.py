"""Chart documents of any size: a document's arrays are read by many tasks.

A document is one line of JSON, and a line is one row of a text scan. For large files the scan is cut at ``],`` instead, the end
of a point, so Spark's reader splits a file into blocks wherever it likes and no row is longer than a few points. What a point
means depends on what stands before it: the array's name and the document's number. Both are found in order inside a block, and
carried from block to block by a table with one row a block. Endpoint and parameters are collected for each document
and joined to its points.

The points equal those of ``chart_points``; only a document that is no valid JSON differs: here the points that can be read
are read. Names and parameters must not contain ``],``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import join_series
from tidemark.operators.parse import (
    ALIGN_KEYS, CHART_FIELDS, DOCUMENT, LINEAGE, PLACE, chart_documents, chart_from_points, chart_points, epoch_ms, place_of,
)
from tidemark.session import materialize
from tidemark.sources.landing import FILE_METADATA, raw_columns, scan_landing

# Files up to this size are parsed a document at a time.
WHOLE_BYTES = 64 << 20
# Documents whose names and parameters may be broadcast.
BROADCAST_DOCUMENTS = 100_000
POINT_END = "],"
# Before the name of an array inside the encoded response, and behind a line break.
PIECES = r'(?<=\n)|(?=\\"\w+\\"\s*:\s*\[)'
ARRAY_NAME = r'^\\"(\w+)\\"\s*:\s*\['
POINT = r"\[\s*([^\[\],\s]+)\s*(?:,\s*([^\[\],\s]+))?"
FILE = "file_path"


def _text_of(key: str) -> Column:
    """A string of the envelope, without its escapes; NULL where this piece does not hold it."""
    found = F.regexp_extract("piece", rf'"{key}"\s*:\s*"((?:[^"\\]|\\.)*)"', 1)
    has = F.contains(F.col("piece"), F.lit(f'"{key}"')) & ~F.contains(F.col("piece"), F.lit(f'\\"{key}\\"'))
    return F.when(has, F.from_json(F.concat(F.lit('{"text":"'), found, F.lit('"}')), "text string")["text"])


def split_points(spark: SparkSession, path: str, larger_than: int = 0, name_has: str = "market_chart") -> DataFrame:
    """The points of files above ``larger_than`` bytes, as ``chart_points`` gives them."""
    scan = spark.read.option("recursiveFileLookup", "true").option("lineSep", POINT_END).text(path)
    cut = scan.select(*raw_columns(), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_n")).filter(
        F.contains(F.col("file_name"), F.lit(name_has)) & (F.col("file_size") > larger_than))
    pieces = cut.select("*", F.posexplode(F.split("data", PIECES)).alias("_piece", "piece"))
    name = F.regexp_extract("piece", ARRAY_NAME, 1)
    ends = F.when(F.endswith(F.col("piece"), F.lit("\n")), 1).otherwise(0)
    pieces = materialize(pieces.select(
        "etl_timestamp", *FILE_METADATA, "_block", "_n", "_piece", F.when(name != "", name).alias("_name"), ends.alias("_ends"),
        _text_of("endpoint").alias("endpoint"), _text_of("parameters").alias("parameters"),
        F.regexp_extract_all("piece", F.lit(POINT), F.lit(1)).alias("_times"),
        F.regexp_extract_all("piece", F.lit(POINT), F.lit(2)).alias("_values")), "pieces")

    inside = Window.partitionBy(FILE, "_block").orderBy("_n", "_piece")
    earlier = Window.partitionBy(FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy(FILE, "_block").agg(
        F.max_by("_name", F.when(F.col("_name").isNotNull(), F.struct("_n", "_piece"))).alias("_last"), F.sum("_ends").alias("_lines"),
    ).select(FILE, "_block", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
             F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    placed = join_series(pieces.withColumns({
        "_own": F.last("_name", ignorenulls=True).over(inside),
        "_line": F.sum("_ends").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_ends")}), blocks, [FILE, "_block"])
    placed = placed.withColumn("_document", F.col("_line") + F.col("_before")).withColumn("field", F.coalesce("_own", "_carried"))

    heads = materialize(placed.filter(F.col("endpoint").isNotNull() | F.col("parameters").isNotNull()).groupBy(FILE, "_document").agg(
        F.max("endpoint").alias("_endpoint"), F.max("parameters").alias("_parameters")), "documents")
    points = placed.filter((F.size("_times") > 0) & F.col("field").isin(*CHART_FIELDS)).drop("endpoint", "parameters")
    joined = join_series(points, heads, [FILE, "_document"], "left", heads.count() <= BROADCAST_DOCUMENTS)
    endpoint = F.col("_endpoint")
    lineage = {
        "etl_timestamp": F.col("etl_timestamp"), "file_name": F.col("file_name"), "file_modification_time": F.col("file_modification_time"),
        "endpoint": endpoint, "coin_id": F.get(F.split(endpoint, "/"), F.lit(2)),
        "vs_currency": F.get_json_object("_parameters", "$.vs_currency"), "days": F.get_json_object("_parameters", "$.days")}
    number = F.concat(F.col(FILE), F.lit("#"), F.col("_document").cast("string"))
    return joined.select(
        *[lineage[name].alias(name) for name in LINEAGE], number.alias(DOCUMENT), "field", "_block", "_n", "_piece",
        F.posexplode(F.arrays_zip("_times", "_values")).alias("_at", "_point"),
    ).select(*LINEAGE, DOCUMENT, "field", epoch_ms(F.col("_point._times").try_cast("double")).alias("timestamp_unix_ms"),
             F.col("_point._values").try_cast("double").alias("value"),
             place_of(F.col("_block"), F.col("_n"), F.col("_piece"), F.col("_at")).alias(PLACE))


def parse_chart_files(
    spark: SparkSession, path: str, keys: Sequence[str] = ALIGN_KEYS, dedup: bool = True, whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """``parse_chart`` of the files under ``path``; those above ``whole_bytes`` are read in blocks.

    Files are told apart by their size before any is opened.
    """
    small = chart_points(chart_documents(scan_landing(spark, path).filter(F.col("file_size") <= whole_bytes)))
    return chart_from_points(small.unionByName(split_points(spark, path, whole_bytes)), keys, dedup)
