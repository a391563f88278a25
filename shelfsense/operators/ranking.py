"""Top-k per key, and the nested list form of a ranked table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(
    df: DataFrame, key: str, k: int, score: str = "r", tie: str = "rid", rank: str = "rank"
) -> DataFrame:
    """The ``k`` rows of highest ``score`` per key, equal scores by ascending ``tie``.

    The rank filter becomes a group limit that also runs before the shuffle, so a key
    holding any share of the rows sends at most ``k`` of them per map task.
    """
    order = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(tie).asc())
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first in ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def nest_recs(ranked: DataFrame, key: str, rid: str = "rid", r: str = "r", rank: str = "rank") -> DataFrame:
    """(key, recs) from rows already cut to a bounded number per key."""
    rows = F.collect_list(F.struct(F.col(rank).alias("rank"), F.col(rid).alias("rid"), F.col(r).alias("r")))
    return ranked.groupBy(key).agg(
        F.transform(F.array_sort(rows), lambda x: F.struct(x["rid"].alias("rid"), x["r"].alias("r"))).alias("recs")
    )


def unnest_recs(nested: DataFrame, key: str, first: int | None = None) -> DataFrame:
    """(key, rank, rid, r) rows; ``first`` keeps only the head of every list."""
    recs = F.col("recs") if first is None else F.slice("recs", 1, first)
    return nested.select(key, F.posexplode(recs).alias("pos", "rec")).select(
        key, (F.col("pos") + 1).alias("rank"), F.col("rec.rid").alias("rid"), F.col("rec.r").alias("r")
    )


def stream_recs_as_recs(stream_recs: DataFrame) -> DataFrame:
    """Bring the differently named fields of the streaming lists to (rid, r)."""
    return stream_recs.select(
        "userId",
        F.transform(
            "recs", lambda x: F.struct(x["productId"].alias("rid"), x["score"].alias("r"))
        ).alias("recs"),
    )
