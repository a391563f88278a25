"""The folder every executor can reach, and reliable lineage cuts inside it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the warehouse, which executors share as well."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created until Spark writes to it."""
    return f"{shared_dir(spark)}/shelfsense/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage, so losing an executor never recomputes it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def settled_alone(df: DataFrame) -> DataFrame:
    """``settled``, and the shuffle files it was made from go at once, not when the driver happens to collect garbage."""
    kept = settled(df)
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)
    return kept
