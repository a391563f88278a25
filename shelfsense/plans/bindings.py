"""Ratings, products and users as read from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.functions.scalars import java_string_hash, wall_clock_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per event, repeated (user, product) pairs included."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("productId"),
        F.col("value").alias("score"),
        wall_clock_seconds(F.col("ts")).alias("ts"),
    )


def order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per order line."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("productId"),
        (F.col("l_quantity") / 10).alias("score"),
        wall_clock_seconds(F.col("l_shipdate")).alias("ts"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.concat_ws("|", F.replace(F.col("p_name"), F.lit(" "), F.lit("|")), "p_brand", "p_type")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("productId"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", "p_type", "p_brand").alias("categories"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("imageUrl"),
        tags.alias("tags"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        java_string_hash(F.col("c_name")).alias("userId"),
        F.col("c_name").alias("username"),
        F.lit(True).alias("first"),
        (F.col("c_custkey") * 1000).alias("created_ms"),
        F.array("c_mktsegment").alias("prefGenres"),
        "c_custkey",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
