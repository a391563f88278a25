import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.functions.vectors import unit
from shelfsense.operators import cones, strips


def clustered(spark, seed=5, n=1500, groups=30, dim=16, spread=0.05):
    """Directions around centres, a third of the rows copies of one of them."""
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(groups, dim))
    x = at[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dim))
    x[:: 3] = x[0]
    rows = spark.createDataFrame([(i * 3, [float(c) for c in v]) for i, v in enumerate(x)], "id bigint, vec array<double>")
    return rows.select("id", unit(F.col("vec")).alias("vec")).cache()


def lists(df):
    return sorted(tuple(r) for r in df.select("id", "rank", "rid", "r").collect())


@pytest.mark.parametrize("above", [-0.2, 0.6, 0.999])
@pytest.mark.parametrize("strip_rows,chunk_rows", [(40, 100), (16384, 1_000_000)])
def test_equals_all_tiles(spark, above, strip_rows, chunk_rows):
    rows = clustered(spark)
    n = rows.count()
    every = strips.top_by_product(rows, rows, 7, ["vec"], strips.DenseStrip, n, n, above=above)
    assert lists(cones.top_by_cosine(rows, 7, n, above, strip_rows, chunk_rows)) == lists(every)


def test_most_strips_are_skipped_where_rows_are_clustered(spark):
    rows = clustered(spark)
    routed, number = cones.routes(rows, rows.count(), 0.9, strip_rows=50)
    assert number >= 30 and cones.read_share(routed, number) < 0.5
    sizes = [r["count"] for r in routed.groupBy("own").count().collect()]
    assert sum(sizes) == rows.count() and max(sizes) < 120  # the copies, a third of the rows, are cut up
    assert routed.where(~F.array_contains("near", F.col("own"))).count() == 0


def test_without_clusters_everything_meets(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 48))
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id bigint, vec array<double>")
    rows = rows.select("id", unit(F.col("vec")).alias("vec"))
    routed, number = cones.routes(rows, 300, 0.6, strip_rows=50)
    assert cones.read_share(routed, number) > 0.9
    assert cones.top_by_cosine(rows.limit(0), 5, 0, 0.6).count() == 0
