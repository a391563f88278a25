"""Answers for whole tables of requests: enrichment, lookups, search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.scalars import halved_score, java_string_hash, now_millis
from shelfsense.operators.joins import join_unique
from shelfsense.operators.patterns import matches
from shelfsense.operators.ranking import first_per_key, unnest_recs
from shelfsense.operators.upsert import newest_ratings


def with_score(products: DataFrame, averages: DataFrame) -> DataFrame:
    """Products with their average score, 0.0 where nobody has rated them."""
    scores = averages.select("productId", F.col("avg").alias("score"))
    return products.join(scores, "productId", "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )


def enrich(recs: DataFrame, products: DataFrame, averages: DataFrame) -> DataFrame:
    """Rows with a ``rid`` completed by product details and score; unknown products drop out.

    The rank column stays, so the order of a list survives the join.
    """
    details = with_score(products, averages).withColumnRenamed("productId", "rid")
    return join_unique(recs, details, "rid", apart=recs.columns)


def recs_for_products(requests: DataFrame, recs: DataFrame, first: int | None = None) -> DataFrame:
    """(productId, rank, rid, r) for the requested products; one without a list gives no rows."""
    wanted = requests.select("productId").distinct()
    return unnest_recs(wanted.join(recs, "productId"), "productId", first)


def recs_for_usernames(
    requests: DataFrame, users: DataFrame, recs: DataFrame, first: int | None = None
) -> DataFrame:
    """(username, rank, rid, r): every requested name once, resolved to its id and that to its list."""
    wanted = requests.select("username").distinct()
    named = wanted.join(users.select("username", "userId"), "username")
    return unnest_recs(named.join(recs, "userId"), "username", first)


def products_by_ids(products: DataFrame, ids: DataFrame) -> DataFrame:
    """Products whose id is in the other table."""
    return products.join(ids.select("productId").distinct(), "productId", "left_semi")


def scored_products_by_ids(products: DataFrame, averages: DataFrame, ids: DataFrame) -> DataFrame:
    """The same with their average scores."""
    return with_score(products_by_ids(products, ids), averages)


def product_by_id(products: DataFrame, product_id: int) -> DataFrame:
    """At most one row, the first by all columns."""
    return first_per_key(products.where(F.col("productId") == product_id), ["productId"], products.columns)


def user_by_name(users: DataFrame, username: str) -> DataFrame:
    """At most one row, that of the smallest id."""
    return first_per_key(users.where(F.col("username") == username), ["username"], ["userId"])


def search(products: DataFrame, patterns: str | Sequence[str]) -> DataFrame:
    """Products whose name holds a match of the case-sensitive pattern, or of any of several.

    Several patterns are tried on each row in place; the result names the pattern.
    """
    if isinstance(patterns, str):
        return products.where(F.col("name").rlike(patterns))
    hits = F.array_compact(
        F.array(*[F.when(F.col("name").rlike(p), F.lit(p)) for p in patterns])
    )
    return products.select(F.explode(hits).alias("pattern"), "*")


def search_table(products: DataFrame, patterns: DataFrame, averages: DataFrame, block: int = 32) -> DataFrame:
    """(pattern, product columns, score) for every row of ``patterns`` (pattern) found in a product's name.

    A pattern is looked up by a piece of text that its matches must hold, see ``patterns.matches``.
    """
    found = matches(products, "name", patterns, block)
    return with_score(found, averages).select("pattern", *products.columns, "score")


def detailed_recs_for_usernames(
    requests: DataFrame,
    users: DataFrame,
    recs: DataFrame,
    products: DataFrame,
    averages: DataFrame,
    first: int | None = None,
) -> DataFrame:
    """(username, rank, rid, r, product details, score): names to ids, lists, products and scores."""
    return enrich(recs_for_usernames(requests, users, recs, first), products, averages)


def ratings_from_requests(requests: DataFrame, users: DataFrame) -> DataFrame:
    """(userId, productId, score, ts) of requests (username, productId, stars, ts) by known users.

    The stored score is half the stars. ``rating_event`` and ``queue_entry`` give the rows' textual forms.
    """
    named = join_unique(requests, users.select("username", "userId"), "username", apart=requests.columns)
    score = halved_score(F.col("stars")).cast("double")
    return named.select("userId", "productId", score.alias("score"), F.col("ts").cast("bigint").alias("ts"))


def new_users(requests: DataFrame, users: DataFrame, created_ms: Column | None = None) -> DataFrame:
    """User rows for the requested names (username) that are not taken, ready to be appended.

    The id is the string hash of the name, ``first`` is set, and the time is now unless given.
    """
    wanted = requests.where("username IS NOT NULL").select("username").distinct()
    unknown = wanted.join(users.select("username"), "username", "left_anti")
    return unknown.select(
        java_string_hash(F.col("username")).alias("userId"),
        "username",
        F.lit(True).alias("first"),
        (now_millis() if created_ms is None else created_ms).cast("bigint").alias("created_ms"),
        F.lit(None).cast("array<string>").alias("prefGenres"),
    )


def ratings_of_pairs(ratings: DataFrame, pairs: DataFrame) -> DataFrame:
    """One rating, the newest, of every requested (userId, productId)."""
    # reduced before the join: a pair rated any number of times is one row there. Where the pairs
    # are few, Catalyst moves their join below the grouping by itself
    newest = newest_ratings(ratings)
    wanted = pairs.select("userId", "productId").distinct()
    return newest.join(wanted, ["userId", "productId"], "left_semi")


def first_rating(ratings: DataFrame) -> DataFrame:
    """The newest rating of every user."""
    return first_per_key(
        ratings, ["userId"], [F.desc("ts"), F.asc("productId"), F.desc("score")]
    )
