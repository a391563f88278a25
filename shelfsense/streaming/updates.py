"""Rating upserts over a stream: batches are kept as they come and merged when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from shelfsense.operators.upsert import upsert_ratings
from shelfsense.schemas import RATING


def start_rating_updates(
    ratings: DataFrame, out: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write each micro-batch to its own folder. The base, however large, is not touched."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = ratings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_ratings(spark: SparkSession, base: DataFrame, out: str) -> DataFrame:
    """The snapshot ``base`` with all written batches applied in order of event time."""
    return upsert_ratings(base, spark.read.schema(RATING).parquet(out))


def compact_ratings(spark: SparkSession, base: DataFrame, out: str, target: str) -> None:
    """A new snapshot at ``target``; the stream goes on with a new ``out``, so that reads stay short."""
    current_ratings(spark, base, out).write.mode("overwrite").parquet(target)
