"""Delimited product and rating text, and rating events inside log lines.

Each reader works on a frame with one text column, so the same code serves
``spark.read.text``, ``spark.readStream.text`` and lines made by another job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.functions.scalars import RATING_EVENT_PREFIX, java_trim, parsed

# Field positions of the caret-delimited product line.
PRODUCT_FIELDS = 7
PRODUCT_ID, PRODUCT_NAME, PRODUCT_IMAGE, PRODUCT_CATEGORIES, PRODUCT_TAGS = 0, 1, 4, 5, 6
RATING_FIELDS = 4

# Fixed value: shape of the event payload; the user id is a string hash and may be negative.
RATING_EVENT_PATTERN = RATING_EVENT_PREFIX + r":(-?\d+)\|(\d+)\|([0-9.]+)\|(\d+)\s*$"


def _field(fields: Column, position: int, needed: int, strict: bool) -> Column:
    value = F.get(fields, F.lit(position))
    if not strict:
        return value
    message = F.concat(F.lit(f"line has fewer than {needed} fields: "), F.array_join(fields, "|"))
    return F.when(F.size(fields) >= needed, value).otherwise(
        F.raise_error(message).cast("string")
    )


def _product_columns(fields: Column, strict: bool) -> list[Column]:
    def at(position: int) -> Column:
        return _field(fields, position, PRODUCT_FIELDS, strict)

    return [
        parsed(at(PRODUCT_ID), "bigint", strict).alias("productId"),
        java_trim(at(PRODUCT_NAME)).alias("name"),
        java_trim(at(PRODUCT_CATEGORIES)).alias("categories"),
        java_trim(at(PRODUCT_IMAGE)).alias("imageUrl"),
        java_trim(at(PRODUCT_TAGS)).alias("tags"),
    ]


def _rating_columns(fields: Column, strict: bool) -> list[Column]:
    def at(position: int) -> Column:
        return _field(fields, position, RATING_FIELDS, strict)

    return [
        parsed(at(0), "bigint", strict).alias("userId"),
        parsed(at(1), "bigint", strict).alias("productId"),
        parsed(at(2), "double", strict).alias("score"),
        parsed(at(3), "bigint", strict).alias("ts"),
    ]


def products_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Products from caret-delimited lines; a malformed line fails the job."""
    return lines.select(*_product_columns(F.split(F.col(col), r"\^"), strict=True))


def ratings_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Ratings from comma-delimited lines; a malformed line fails the job."""
    return lines.select(*_rating_columns(F.split(F.col(col), ","), strict=True))


def _accepted_and_rejected(
    lines: DataFrame, col: str, fields: Column, columns: list[Column], needed: int, must: list[str]
) -> tuple[DataFrame, DataFrame]:
    wide = lines.select(F.col(col), (F.size(fields) >= needed).alias("_complete"), *columns)
    good = F.coalesce(F.col("_complete"), F.lit(False))
    for name in must:
        good = good & F.col(name).isNotNull()
    accepted = wide.where(good).drop(col, "_complete")
    return accepted, wide.where(~good).select(col)


def split_product_lines(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(products, rejected lines): the lenient form, losing no line silently."""
    fields = F.split(F.col(col), r"\^")
    return _accepted_and_rejected(
        lines, col, fields, _product_columns(fields, strict=False), PRODUCT_FIELDS, ["productId"]
    )


def split_rating_lines(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(ratings, rejected lines): the lenient form, losing no line silently."""
    fields = F.split(F.col(col), ",")
    return _accepted_and_rejected(
        lines,
        col,
        fields,
        _rating_columns(fields, strict=False),
        RATING_FIELDS,
        ["userId", "productId", "score", "ts"],
    )


def ratings_from_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Ratings from tagged log lines; every other line is dropped. Works on streams too."""

    def group(i: int, type_name: str) -> Column:
        return F.regexp_extract(F.col(col), RATING_EVENT_PATTERN, i).try_cast(type_name)

    return (
        lines.where(F.contains(F.col(col), F.lit(RATING_EVENT_PREFIX)))
        .select(
            group(1, "bigint").alias("userId"),
            group(2, "bigint").alias("productId"),
            group(3, "double").alias("score"),
            group(4, "bigint").alias("ts"),
        )
        .where("userId IS NOT NULL AND productId IS NOT NULL AND score IS NOT NULL AND ts IS NOT NULL")
    )


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return products_from_lines(spark.read.text(path))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return ratings_from_lines(spark.read.text(path))


def read_rating_log(spark: SparkSession, path: str) -> DataFrame:
    return ratings_from_log(spark.read.text(path))


def stream_rating_log(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Rating events as an unbounded frame over a folder that log files are moved into."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return ratings_from_log(reader.text(path))


def distinct_events(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Rating events of a stream, each once, however often its lines are replayed.

    An event is the same if user, product, score and time are. What is remembered of it is dropped when the newest
    event is ``late`` younger; lines older than that are late, replayed or not, and left out.
    """
    return (
        events.withColumn("_at", F.timestamp_seconds("ts"))
        .withWatermark("_at", late)
        .dropDuplicatesWithinWatermark(["userId", "productId", "score", "ts"])
        .drop("_at")
    )
