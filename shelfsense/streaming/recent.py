"""Recent lists kept over a stream of ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from shelfsense.operators.recent import QUEUE_LENGTH, recent_lists, recent_ratings
from shelfsense.schemas import RATING
from shelfsense.streaming.batches import read_batches


def start_recent_lists(
    ratings: DataFrame, out: str, checkpoint: str, n: int = QUEUE_LENGTH, available_now: bool = False
) -> StreamingQuery:
    """Write the ``n`` newest ratings of every user of a micro-batch to the batch's own folder.

    The rank filter cuts a user to ``n`` rows a map task before the shuffle, whatever their share of the batch;
    there is no state, and a repeated batch replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        recent_ratings(batch, n).drop("pos").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = ratings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_recent_lists(spark: SparkSession, *outs: str, n: int = QUEUE_LENGTH) -> DataFrame:
    """(userId, recent) from all batches written to ``outs``: order is by event time, so late files change nothing."""
    return recent_lists(read_batches(spark, RATING, *outs), n)


def compact_recent_lists(spark: SparkSession, outs: list[str], target: str, n: int = QUEUE_LENGTH) -> None:
    """One folder in place of many batches: at most ``n`` rows a user. ``target`` is read instead of ``outs``."""
    rows = recent_ratings(read_batches(spark, RATING, *outs), n).drop("pos")
    rows.write.mode("overwrite").parquet(f"{target}/batch_id=0")
