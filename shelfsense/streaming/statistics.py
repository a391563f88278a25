"""Rating statistics kept up over a stream: partial sums a micro-batch, added up when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from shelfsense.operators.popularity import merged_statistics, partial_statistics
from shelfsense.schemas import STATISTICS
from shelfsense.streaming.batches import read_batches


def start_statistics(
    ratings: DataFrame, out: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write the partial statistics of a micro-batch to the batch's own folder, which a repeated batch replaces.

    Earlier ratings are never read again, and a product sends one row a map task and month, whatever its share.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        partial_statistics(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = ratings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_statistics(spark: SparkSession, *outs: str) -> DataFrame:
    """Partial statistics of all batches written to ``outs``, one row a month and product."""
    return merged_statistics(read_batches(spark, STATISTICS, *outs))


def compact_statistics(spark: SparkSession, outs: list[str], target: str) -> None:
    """One folder in place of many batches. ``target`` is read instead of ``outs``."""
    current_statistics(spark, *outs).write.mode("overwrite").parquet(f"{target}/batch_id=0")
