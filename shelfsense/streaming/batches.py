"""Folders of micro-batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_batches(spark: SparkSession, schema: StructType, *outs: str) -> DataFrame:
    """All rows in the batch folders of ``outs``, each of which is a root of its own."""
    return reduce(DataFrame.unionByName, (spark.read.schema(schema).parquet(out) for out in outs))
