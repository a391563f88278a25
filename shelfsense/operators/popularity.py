"""Rating counts, monthly counts, averages, and the lists served from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.scalars import year_month


def rate_more(ratings: DataFrame) -> DataFrame:
    """Ratings per product."""
    return ratings.groupBy("productId").agg(F.count("productId").alias("count"))


def with_month(ratings: DataFrame) -> DataFrame:
    return ratings.select("productId", "score", year_month(F.col("ts")).alias("yearmonth"))


def rate_more_recently(ratings: DataFrame) -> DataFrame:
    """Ratings per month and product."""
    return (
        with_month(ratings)
        .groupBy("yearmonth", "productId")
        .agg(F.count("productId").alias("count"))
    )


def average_scores(ratings: DataFrame) -> DataFrame:
    """Mean score per product."""
    return ratings.groupBy("productId").agg(F.avg("score").alias("avg"))


def partial_statistics(ratings: DataFrame) -> DataFrame:
    """(yearmonth, productId, count, n_scores, total): what the counts and the mean of these ratings add up from."""
    return (
        with_month(ratings)
        .groupBy("yearmonth", "productId")
        .agg(F.count("productId").alias("count"), F.count("score").alias("n_scores"), F.sum("score").alias("total"))
    )


def merged_statistics(partials: DataFrame) -> DataFrame:
    """The same of all ratings that ``partials`` were made of, one row a month and product."""
    sums = (F.sum(name).alias(name) for name in ("count", "n_scores", "total"))
    return partials.groupBy("yearmonth", "productId").agg(*sums)


def statistics_of(partials: DataFrame) -> DataFrame:
    """(productId, count, avg), as ``rate_more`` and ``average_scores`` give them; null without a score."""
    mean = F.sum("total") / F.nullif(F.sum("n_scores"), F.lit(0))
    return partials.groupBy("productId").agg(F.sum("count").alias("count"), mean.alias("avg"))


def by_average(averages: DataFrame) -> DataFrame:
    return averages.orderBy(F.desc("avg"), "productId")


def hot(monthly: DataFrame, n: int) -> DataFrame:
    """The newest month first, within it the most rated."""
    return monthly.orderBy(F.desc("yearmonth"), F.desc("count"), "productId").limit(n)


def most_rated(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), "productId").limit(n)


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("userId").distinct()
