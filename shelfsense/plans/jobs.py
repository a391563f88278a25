"""The batch jobs, each reading and writing named collections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfsense import schemas as S
from shelfsense.operators import content, corating, latent, popularity
from shelfsense.operators.ranking import nest_recs
from shelfsense.operators.upsert import newest_ratings, upsert_ratings
from shelfsense.sources.catalog import Catalog
from shelfsense.sources.text import read_products, read_ratings


def load(catalog: Catalog, product_path: str, rating_path: str) -> None:
    """Delimited text into the product and rating collections."""
    catalog.overwrite(S.PRODUCTS_COLLECTION, read_products(catalog.spark, product_path))
    catalog.overwrite(S.RATING_COLLECTION, read_ratings(catalog.spark, rating_path))


def apply_updates(catalog: Catalog, updates: DataFrame, target: Catalog) -> None:
    """Ratings with all updates applied, as a new snapshot: plain files cannot be changed in place."""
    if target.path(S.RATING_COLLECTION) == catalog.path(S.RATING_COLLECTION):
        raise ValueError("the updated collection must not replace the one it is made from")
    base = newest_ratings(catalog.read(S.RATING_COLLECTION))
    target.overwrite(S.RATING_COLLECTION, upsert_ratings(base, updates))


def statistics(catalog: Catalog) -> None:
    """Counts, monthly counts and averages per product."""
    ratings = catalog.read(S.RATING_COLLECTION)
    catalog.overwrite(S.RATE_MORE_COLLECTION, popularity.rate_more(ratings))
    catalog.overwrite(S.RATE_MORE_RECENTLY_COLLECTION, popularity.rate_more_recently(ratings))
    averages = popularity.average_scores(ratings)
    catalog.overwrite(S.AVERAGE_COLLECTION, popularity.by_average(averages))


def _write_recs(catalog: Catalog, name: str, ranked: DataFrame, key: str = "productId") -> None:
    catalog.overwrite(name, nest_recs(ranked, key))


def item_lists(catalog: Catalog, k: int = 5, dedupe: bool = True) -> None:
    """Items similar by co-rating."""
    ranked = corating.similar_by_co_rating(catalog.read(S.RATING_COLLECTION), k, dedupe)
    _write_recs(catalog, S.ITEMCF_COLLECTION, ranked)


def content_lists(catalog: Catalog, k: int = 5, hashed: bool = False) -> None:
    """Items similar by tags."""
    ranked = content.similar_by_content(catalog.read(S.PRODUCTS_COLLECTION), k, hashed=hashed)
    _write_recs(catalog, S.CONTENT_COLLECTION, ranked)


def factor_lists(
    catalog: Catalog, user_k: int = latent.USER_LIST, item_k: int = latent.ITEM_LIST
) -> None:
    """Train once, then lists per user and items similar by factors."""
    model = latent.fit_als(catalog.read(S.RATING_COLLECTION))
    per_user = latent.recommend_to_users(model, catalog.read(S.PRODUCTS_COLLECTION), user_k)
    _write_recs(catalog, S.USER_RECS_COLLECTION, per_user, "userId")
    similar = latent.similar_by_factors(latent.factors(model.itemFactors), item_k)
    _write_recs(catalog, S.FACTOR_RECS_COLLECTION, similar)
