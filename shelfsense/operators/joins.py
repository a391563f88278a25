"""Joins in which one key may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task should join, and keys at most that are dealt to several parts.
ROWS_PER_PART, MOST_HEAVY = 100_000, 10_000


def join_unique(
    rows: DataFrame,
    unique: DataFrame,
    key: str,
    apart: list[str],
    how: str = "inner",
    per_part: int = ROWS_PER_PART,
    counted: str | None = None,
) -> DataFrame:
    """Join ``rows`` with ``unique``, which has one row per key.

    One aggregate measures how often every key occurs. The rows of a key are dealt to as many parts as ``per_part``
    asks for, by their ``apart`` columns, and the row of ``unique`` is repeated as often. Only the ``MOST_HEAVY`` most
    frequent keys are dealt so, which bounds the list that is broadcast; any other key holds at most one row in
    ``MOST_HEAVY`` and stays in one part. Where a column of ``unique`` holds the frequencies already, ``counted`` names
    it and nothing is measured.
    """
    if counted is None:
        measured = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        measured = unique.select(key, F.col(counted).alias("_rows"))
    heavy = (
        measured.select(key, F.ceil(F.col("_rows") / per_part).cast("int").alias("_ways"))
        .where(F.col(key).isNotNull() & (F.col("_ways") > 1))
        .orderBy(F.col("_ways").desc(), key)
        .limit(MOST_HEAVY)
    )
    ways = F.coalesce("_ways", F.lit(1))
    salted = (
        rows.join(F.broadcast(heavy), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*apart), ways).cast("int"))
        .drop("_ways")
    )
    repeated = (
        unique.join(F.broadcast(heavy), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), ways - 1)))
        .drop("_ways")
    )
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
