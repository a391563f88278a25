import pytest
from pyspark.sql import functions as F

from shelfsense.operators.joins import join_unique


@pytest.mark.parametrize("per_part", [1, 30, 100_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_the_plain_join(spark, per_part, how):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 17 != 1, F.col("id") % 50)
    rows = spark.range(600).select("id", key.alias("k"))
    unique = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = join_unique(rows, unique, "k", ["id"], how, per_part)
    wanted = rows.join(unique, "k", how)
    assert got.columns == wanted.columns
    assert sorted(got.collect(), key=str) == sorted(wanted.collect(), key=str)


def test_known_frequencies_are_not_measured_again(spark):
    rows = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    unique = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = join_unique(rows, unique, "k", ["id"], per_part=30, counted="n")
    assert sorted(got.collect()) == sorted(rows.join(unique, "k").collect())


def test_parts_follow_the_frequency_of_a_key(spark):
    """A key with a third of the rows: no task gets more than a small share of them."""
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    unique = spark.range(-1, 9000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = join_unique(rows, unique, "k", ["id"], per_part=50).withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 9000 and max(sizes) < 0.06 * 9000
