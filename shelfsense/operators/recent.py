"""The newest ratings of every user, newest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.functions.scalars import queue_entry, queue_key

# Fixed value: length of the queue.
QUEUE_LENGTH = 40


def recent_ratings(ratings: DataFrame, n: int = QUEUE_LENGTH) -> DataFrame:
    """(userId, productId, score, ts, pos): the ``n`` newest per user; equal times by product id."""
    newest = Window.partitionBy("userId").orderBy(F.desc("ts"), F.asc("productId"), F.desc("score"))
    return (
        ratings.select("userId", "productId", "score", "ts")
        .withColumn("pos", F.row_number().over(newest))
        .where(F.col("pos") <= n)
    )


def recent_lists(ratings: DataFrame, n: int = QUEUE_LENGTH) -> DataFrame:
    """(userId, recent): the same, one row per user."""
    entries = F.collect_list(F.struct("pos", "productId", "score", "ts"))
    return (
        recent_ratings(ratings, n)
        .groupBy("userId")
        .agg(
            F.transform(
                F.array_sort(entries),
                lambda x: F.struct(
                    x["productId"].alias("productId"), x["score"].alias("score"), x["ts"].alias("ts")
                ),
            ).alias("recent")
        )
    )


def unnest_recent(lists: DataFrame) -> DataFrame:
    return lists.select("userId", F.posexplode("recent").alias("pos", "e")).select(
        "userId", "e.productId", "e.score", "e.ts", (F.col("pos") + 1).alias("pos")
    )


def queue_entries(recent: DataFrame) -> DataFrame:
    """(queue, pos, entry): the textual form of the queues."""
    return recent.select(
        queue_key(F.col("userId")).alias("queue"),
        "pos",
        queue_entry(F.col("productId"), F.col("score")).alias("entry"),
    )
