"""Update-or-insert: the updates are reduced, the base is only joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_ratings(ratings: DataFrame) -> DataFrame:
    """(userId, productId, score, ts): one row per pair, its newest, of equal times the highest score.

    Two groupings over plain numbers, which hash and need no sort. Snapshots are written this way, so that
    whoever updates one need not make it unique again.
    """
    per_time = ratings.groupBy("userId", "productId", "ts").agg(F.max("score").alias("score"))
    return per_time.groupBy("userId", "productId").agg(
        F.max_by("score", "ts").alias("score"), F.max("ts").alias("ts")
    )


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: list[str],
    set_cols: list[str],
    update_order: str,
    insert: bool = True,
) -> DataFrame:
    """``base``, which has one row per key, after all updates as if applied one by one in ``update_order``.

    An update of a known key replaces ``set_cols`` alone. An unknown key is inserted by its first update
    (or ignored with ``insert=False``). Updates are reduced to one row per key; the base meets them in a join,
    which Spark broadcasts where they are few, and is neither sorted for a grouping nor grouped.
    """
    kept = [c for c in base.columns if c not in keys and c not in set_cols]
    rest = [
        (F.col(c) if c in updates.columns else F.lit(None)).cast(base.schema[c].dataType).alias(c) for c in kept
    ]
    new_set = F.struct(*[F.col(c).cast(base.schema[c].dataType).alias(c) for c in set_cols])
    latest = (
        updates.select(
            *keys,
            F.col(update_order).cast("bigint").alias("_order"),
            new_set.alias("_set"),
            (F.struct(*rest) if rest else F.lit(None).cast("struct<_none:int>")).alias("_rest"),
        )
        .groupBy(*keys)
        .agg(
            F.max_by("_set", F.struct("_order", "_set")).alias("_set"),
            F.min_by("_rest", F.struct("_order", "_set", "_rest")).alias("_rest"),
        )
    )

    def column(c: str):
        if c not in set_cols:
            return F.col(c)
        return F.when(F.col("_set").isNotNull(), F.col("_set")[c]).otherwise(F.col(c)).alias(c)

    updated = base.join(latest.drop("_rest"), keys, "left").select(*map(column, base.columns))
    if not insert:
        return updated
    unknown = latest.join(base.select(*keys), keys, "left_anti")
    sources = {**{c: F.col("_set")[c] for c in set_cols}, **{c: F.col("_rest")[c] for c in kept}}
    return updated.unionByName(unknown.select(*(sources.get(c, F.col(c)).alias(c) for c in base.columns)))


def upsert_ratings(base: DataFrame, updates: DataFrame, touch_ts: bool = False) -> DataFrame:
    """New scores for known (userId, productId) pairs, new rows for the others.

    A known pair keeps its old time unless ``touch_ts`` is set. ``base`` is a snapshot (``newest_ratings``).
    """
    keys = ["userId", "productId"]
    return upsert(base, updates, keys, ["score", "ts"] if touch_ts else ["score"], "ts")


def update_users(users: DataFrame, updates: DataFrame, update_order: str = "updated_ms") -> DataFrame:
    """New ``first`` and ``prefGenres`` for known users; unknown ids are ignored."""
    return upsert(users, updates, ["userId"], ["first", "prefGenres"], update_order, insert=False)
