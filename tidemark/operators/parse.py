"""Parsing the double-encoded JSON envelope into chart and OHLC rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timestamps import epoch_ms_text
from tidemark.operators.dedup import CHART_KEY, dedup_ohlc, keep_one
from tidemark.session import materialize

# Shapes of the documents, fixed values.
ENVELOPE = "struct<endpoint:string, parameters:string, response:string>"
CHART_PAYLOAD = ("struct<prices:array<array<double>>, market_caps:array<array<double>>, "
                 "total_volumes:array<array<double>>>")
CHART_FIELDS = {"prices": "price", "market_caps": "market_cap", "total_volumes": "total_volume"}
OHLC_PAYLOAD = "array<array<double>>"
# Milliseconds of the years 1 and 9999, between which an epoch has a timestamp and a text.
EPOCH_MIN, EPOCH_MAX = -62_135_596_800_000, 253_402_300_799_999

LINEAGE = ("etl_timestamp", "file_name", "file_modification_time",
           "endpoint", "coin_id", "vs_currency", "days")
ALIGN_KEYS = ("file_name", "coin_id", "vs_currency", "timestamp_unix_ms")
# Which document a point stood in, and a value that orders the points of one document.
DOCUMENT, PLACE = "_document", "_place"
CHART_COLUMNS = (*LINEAGE, "timestamp_unix_ms", "timestamp_raw", "timestamp", "price", "market_cap", "total_volume")


def open_envelopes(raw: DataFrame, payload: str, wanted: Column) -> DataFrame:
    """Rows of ``raw`` that pass ``wanted`` and hold text, with the payload parsed.

    The coin is element 2 of the endpoint split on ``/``. A missing response, and a line
    that is not JSON, leave the payload NULL; exploding it gives no rows. A filter on the
    response here would parse every envelope twice.
    """
    wrapper = F.from_json("data", ENVELOPE)
    return (
        raw.filter(wanted & F.col("data").isNotNull())
        .select("etl_timestamp", "file_name", "file_modification_time", wrapper.alias("wrapper"))
        .select(
            "etl_timestamp", "file_name", "file_modification_time",
            F.col("wrapper.endpoint").alias("endpoint"),
            F.get(F.split("wrapper.endpoint", "/"), F.lit(2)).alias("coin_id"),
            F.get_json_object("wrapper.parameters", "$.vs_currency").alias("vs_currency"),
            F.get_json_object("wrapper.parameters", "$.days").alias("days"),
            F.from_json("wrapper.response", payload).alias("payload"),
        )
    )


def epoch_ms(number: Column) -> Column:
    """Whole milliseconds; NULL for what is no point in time, so that one bad record stops nothing."""
    # NaN and infinities compare as larger than any number.
    return F.when((number >= EPOCH_MIN) & (number <= EPOCH_MAX), number.try_cast("long"))


def chart_documents(raw: DataFrame) -> DataFrame:
    return open_envelopes(raw, CHART_PAYLOAD, F.contains(F.col("file_name"), F.lit("market_chart")))


def ohlc_documents(raw: DataFrame) -> DataFrame:
    return open_envelopes(raw, OHLC_PAYLOAD, F.col("file_name").like("%ohlc%"))


def chart_points(documents: DataFrame) -> DataFrame:
    """One row per ``[epoch_ms, value]`` point, with the array it stood in as ``field``, its document and its place there.

    All three arrays are exploded at once, so a document is read and parsed once. Documents are numbered anew by each run.
    """
    missing = F.array().cast("array<array<double>>")

    def tagged(field: str) -> Column:
        return F.transform(F.coalesce(F.col(f"payload.{field}"), missing), lambda point, at: F.struct(
            F.lit(field).alias("field"),
            epoch_ms(F.get(point, F.lit(0))).alias("timestamp_unix_ms"),
            F.get(point, F.lit(1)).alias("value"),
            place_of(F.lit(0), F.lit(0), F.lit(0), at).alias(PLACE)))

    # Numbered in a step of its own: beside the explosion every point would get a number.
    numbered = documents.withColumn(DOCUMENT, F.monotonically_increasing_id().cast("string"))
    return numbered.select(*LINEAGE, DOCUMENT, F.inline(F.concat(*[tagged(field) for field in CHART_FIELDS])))


def place_of(block: Column, record: Column, piece: Column, at: Column) -> Column:
    """The order of points in a document: by block of the file, record and piece where it is read in blocks, and number."""
    parts = {"block": block, "record": record, "piece": piece, "at": at}
    return F.struct(*[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in parts.items()])


def points_of(points: DataFrame, field: str) -> DataFrame:
    """The points of one array, the value under its column name."""
    return points.filter(F.col("field") == field).select(
        *LINEAGE, "timestamp_unix_ms", F.col("value").alias(CHART_FIELDS[field]))


def usable(df: DataFrame) -> DataFrame:
    """Rows that belong to a coin and have an epoch."""
    return df.filter(F.col("coin_id").isNotNull() & F.col("timestamp_unix_ms").isNotNull())


def quarantine(df: DataFrame) -> DataFrame:
    """Rows left out of the tables: no coin in the endpoint, or no usable epoch."""
    return df.filter(F.col("coin_id").isNull() | F.col("timestamp_unix_ms").isNull())


def quarantined(raw: DataFrame) -> DataFrame:
    """What parsing leaves out of the tables, with where it came from and why.

    Chart points and OHLC records without a coin or a usable epoch, and OHLC records of fewer than five
    elements. ``record`` is the point as it stands in the document.
    """
    def rows(documents: DataFrame, kind: str, records: Column, short: int) -> DataFrame:
        epoch = epoch_ms(F.get("record", F.lit(0)))
        reason = (F.when(F.col("coin_id").isNull(), "no coin").when(F.col("record").isNull(), "no record")
                  .when(F.size("record") < short, "short record").when(epoch.isNull(), "no epoch"))
        return (documents.select(*LINEAGE, F.explode(records).alias("record"))
                .withColumn("reason", reason).filter(F.col("reason").isNotNull())
                .select(*LINEAGE, F.lit(kind).alias("kind"), F.to_json("record").alias("record"), "reason"))

    arrays = F.concat(*[F.coalesce(F.col(f"payload.{field}"), F.array().cast("array<array<double>>")) for field in CHART_FIELDS])
    return rows(chart_documents(raw), "market_chart", arrays, 0).unionByName(
        rows(ohlc_documents(raw), "ohlc", F.col("payload"), 5))


def _join_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Copies of the keys in which a missing text compares equal to a missing text."""
    types = dict(df.dtypes)
    missing = F.lit("\u0000")
    return df.withColumns({
        f"_key_{k}": F.coalesce(F.col(k), missing) if types[k] == "string" else F.col(k) for k in keys})


def lowest_per_key(points: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One value per key: NULL if the key has one, else the smallest.

    That is the value a total order over all output columns would keep. Aggregating
    before the join keeps copies of a point from multiplying and combines them before
    the shuffle.
    """
    has_null = F.count(F.lit(1)) > F.count(value)
    return points.groupBy(*keys).agg(F.when(~has_null, F.min(value)).alias(value))


def align_chart(
    prices: DataFrame, caps: DataFrame, volumes: DataFrame, keys: Sequence[str] = ALIGN_KEYS
) -> DataFrame:
    """Attach market cap and volume to price points with equal keys; prices stay whole.

    ``keys=["timestamp_unix_ms"]`` matches on time alone, which can mix coins.
    """
    on = [f"_key_{k}" for k in keys]
    return (
        _join_keys(prices, keys)
        .join(lowest_per_key(_join_keys(caps, keys), on, "market_cap"), on, "left")
        .join(lowest_per_key(_join_keys(volumes, keys), on, "total_volume"), on, "left")
        .drop(*on)
    )


def prices_with_own(points: DataFrame) -> DataFrame:
    """Usable price points with the market cap and volume that stand beside them in their document.

    Where a document holds as many points of a millisecond in the other array as in ``prices``, the first belongs to the
    first, the second to the second. ``_own_`` columns tell whether a point has such a partner.
    """
    same = (DOCUMENT, "timestamp_unix_ms")
    known = points.filter(F.col("timestamp_unix_ms").isNotNull() & F.col("coin_id").isNotNull()).repartition(*same)
    alike = Window.partitionBy(*same, "field")
    numbered = known.withColumns({"_nth": F.row_number().over(alike.orderBy(PLACE)), "_of": F.count(F.lit(1)).over(alike)})

    def of(field: str, column: Column) -> Column:
        return F.max(F.when(F.col("field") == field, column))

    # At most one row of each array has the same document, millisecond and number.
    rows = numbered.groupBy(*same, "_nth").agg(
        *[F.first(c).alias(c) for c in LINEAGE],
        *[of(field, F.col("value")).alias(name) for field, name in CHART_FIELDS.items()],
        *[of(field, F.col("_of")).alias(f"_of_{name}") for field, name in CHART_FIELDS.items()])
    own = {name: F.coalesce(F.col(f"_of_{name}") == F.col("_of_price"), F.lit(False)) for name in ("market_cap", "total_volume")}
    return rows.filter(F.col("_of_price").isNotNull()).select(
        *LINEAGE, "timestamp_unix_ms", "price",
        *[found.alias(f"_own_{name}") for name, found in own.items()],
        *[F.when(found, F.col(name)).alias(f"_{name}") for name, found in own.items()])


def with_times(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "timestamp_raw": epoch_ms_text(F.col("timestamp_unix_ms")),
        "timestamp": F.timestamp_millis("timestamp_unix_ms"),
    })


def parse_chart(raw: DataFrame, keys: Sequence[str] = ALIGN_KEYS, dedup: bool = True) -> DataFrame:
    """Chart rows from raw documents: explode, keep one load per point, align, stamp."""
    return chart_from_points(chart_points(chart_documents(raw)), keys, dedup)


def chart_from_points(points: DataFrame, keys: Sequence[str] = ALIGN_KEYS, dedup: bool = True) -> DataFrame:
    """Chart rows from the points of all arrays.

    The points are stored in between: three readers of a column table cost less than
    three parses of the text.

    A price takes the values beside it in its document; one without takes those of equal ``keys``.
    Copies are removed on the price side before the joins, and the values beside a price are the last
    in their order. Rows that tie on all of it attach the same values.
    """
    points = materialize(points, "points")
    prices = prices_with_own(points)
    if dedup:
        prices = keep_one(prices, CHART_KEY)
    aligned = align_chart(prices, points_of(points, "market_caps"), points_of(points, "total_volumes"), keys)
    chosen = {name: F.when(F.col(f"_own_{name}"), F.col(f"_{name}")).otherwise(F.col(name)) for name in ("market_cap", "total_volume")}
    return with_times(aligned.withColumns(chosen)).select(*CHART_COLUMNS)


def explode_ohlc(documents: DataFrame) -> DataFrame:
    """One row per ``[epoch_ms, open, high, low, close]`` record with all five elements."""
    names = ("open_price", "high_price", "low_price", "close_price")
    return (
        documents.select(*LINEAGE, F.explode("payload").alias("record"))
        .filter(F.size("record") >= 5)
        .select(*LINEAGE, epoch_ms(F.get("record", F.lit(0))).alias("timestamp_unix_ms"),
                *[F.get("record", F.lit(i + 1)).alias(name) for i, name in enumerate(names)])
    )


def parse_ohlc(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """OHLC rows from raw documents, one load per record."""
    rows = usable(explode_ohlc(ohlc_documents(raw)))
    rows = dedup_ohlc(rows) if dedup else rows
    return with_times(rows).select(
        *LINEAGE, "timestamp_unix_ms", "timestamp_raw", "timestamp",
        "open_price", "high_price", "low_price", "close_price")
