"""Latent factors: ALS, lists per user, and items similar by their factors."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.vectors import dot, unit
from shelfsense.operators.cones import top_by_cosine
from shelfsense.operators.strips import DenseStrip, top_by_product
from shelfsense.operators.upsert import newest_ratings
from shelfsense.shared import settled

# Training parameters and list lengths.
RANK, ITERATIONS, REGULARISATION = 50, 5, 0.01
USER_LIST, ITEM_LIST, STRONG = 20, 10, 0.6


def newest_per_pair(ratings: DataFrame) -> DataFrame:
    """One rating per user and product: the newest, combined before the shuffle."""
    return newest_ratings(ratings).select("userId", "productId", "score")


def fit_als(
    ratings: DataFrame,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    regularisation: float = REGULARISATION,
    seed: int = 42,
    dedupe: bool = True,
) -> ALSModel:
    """Explicit-feedback factors. Ratings are one per pair by design; ``dedupe`` makes sure of it."""
    rows = newest_per_pair(ratings) if dedupe else ratings
    rows = rows.select(
        F.col("userId").cast("int").alias("userId"),
        F.col("productId").cast("int").alias("productId"),
        F.col("score").cast("float").alias("score"),
    )
    als = ALS(
        userCol="userId",
        itemCol="productId",
        ratingCol="score",
        rank=rank,
        maxIter=iterations,
        regParam=regularisation,
        coldStartStrategy="drop",
        seed=seed,
    )
    # training reads its input more than once and takes long: neither a second pass over the
    # ratings nor a lost executor should mean reducing them again
    return als.fit(settled(rows))


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` (userId, productId) with their ``prediction``; pairs of an untrained user or product vanish."""
    asked = pairs.select(F.col("userId").cast("int").alias("userId"), F.col("productId").cast("int").alias("productId"))
    return model.transform(asked).select(
        F.col("userId").cast("bigint").alias("userId"), F.col("productId").cast("bigint").alias("productId"), "prediction"
    )


def user_residuals(ratings: DataFrame, model: ALSModel, regularisation: float = REGULARISATION) -> DataFrame:
    """(userId, n, residual, scale): how far users' factors are from the solution of their own least squares.

    Users are solved last in training, so x of a user with ratings s of products with factors v satisfies
    sum (s - x.v) v = regularisation * n * x. ``residual`` is the largest component of the difference, ``scale`` the
    largest of sum |s| |v|. A rating is one row, whose components are added up side by side before the shuffle, so a
    user may have any share of the rows.
    """
    users, items = factors(model.userFactors).toDF("userId", "x"), factors(model.itemFactors).toDF("productId", "v")
    error = F.col("score") - dot(F.col("x"), F.col("v"))
    rows = ratings.join(users, "userId").join(items, "productId").select("userId", error.alias("e"), "score", "v")
    at = range(model.rank)
    sums = rows.groupBy("userId").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col("e") * F.get("v", F.lit(i))).alias(f"pulled{i}") for i in at],
        *[F.sum(F.abs(F.col("score") * F.get("v", F.lit(i)))).alias(f"scale{i}") for i in at],
    )
    off = [F.abs(F.col(f"pulled{i}") - regularisation * F.col("n") * F.get("x", F.lit(i))) for i in at]
    return sums.join(users, "userId").select(
        "userId",
        "n",
        F.array_max(F.array(*off)).alias("residual"),
        F.array_max(F.array(*[f"scale{i}" for i in at])).alias("scale"),
    )


def factors(df: DataFrame, id_col: str = "id", vec_col: str = "features") -> DataFrame:
    """(id, vec) with a bigint id and doubles, as the tile operators take them."""
    return df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
    )


def score_top_k(
    user_factors: DataFrame,
    item_factors: DataFrame,
    k: int = USER_LIST,
    above: float | None = 0.0,
    digits: int | None = 6,
) -> DataFrame:
    """(userId, rid, r, rank): the ``k`` best positive predictions of every user.

    Every user is scored against every item, block against block; only what is listed becomes a row.
    """
    users, items = settled(user_factors), settled(item_factors)
    n_items = items.count()
    best = top_by_product(
        users,
        items,
        k,
        ["vec"],
        DenseStrip,
        users.count(),
        n_items,
        above=above,
        digits=digits,
        skip_self=False,
    )
    return best.withColumnRenamed("id", "userId")


def recommend_to_users(model: ALSModel, catalogue: DataFrame, k: int = USER_LIST) -> DataFrame:
    """Lists for every trained user over the catalogue's products; untrained ids drop out."""
    listed = catalogue.select(F.col("productId").cast("bigint").alias("id")).distinct()
    items = factors(model.itemFactors).join(listed, "id", "left_semi")
    return score_top_k(factors(model.userFactors), items, k)


def similar_by_factors(item_factors: DataFrame, k: int = ITEM_LIST, above: float = STRONG) -> DataFrame:
    """(productId, rid, r, rank): items whose cosine exceeds ``above``; zero vectors have none."""
    scaled = settled(
        item_factors.select("id", unit(F.col("vec")).alias("vec")).where("vec IS NOT NULL")
    )
    n = scaled.count()
    best = top_by_cosine(scaled, k, n, above)
    return best.withColumnRenamed("id", "productId")
