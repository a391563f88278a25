"""Array-of-number expressions for pairs that are already side by side in a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null, not NaN, where either vector has no length."""
    return F.try_divide(dot(a, b), F.nullif(norm(a) * norm(b), F.lit(0.0)))


def unit(a: Column) -> Column:
    """``a`` scaled to length one; null for a zero vector, so that callers can drop it."""
    # bound as a lambda variable, or the length would be computed anew for every element
    scaled = F.transform(
        F.array(norm(a)),
        lambda n: F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)),
    )
    return F.get(scaled, F.lit(0))


def co_rating_similarity(both: Column, first: Column, second: Column) -> Column:
    """both / sqrt(first * second), the product taken in floating point so it cannot overflow."""
    return both.cast("double") / F.sqrt(first.cast("double") * second.cast("double"))
