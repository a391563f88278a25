from collections import defaultdict

import numpy as np
import pytest

from shelfsense.operators import latent, strips
from shelfsense.operators.strips import DenseStrip, top_by_product


def frame(spark, matrix, ids):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>")


def ranked(df, key):
    lists = defaultdict(list)
    for row in df.orderBy(key, "rank").collect():
        lists[row[key]].append((row.rid, row.r))
    return dict(lists)


def best(scores, row_ids, col_ids, k, above, skip_self):
    out = {}
    for i, a in enumerate(row_ids):
        rows = [
            (-round(scores[i, j], 6) + 0.0, int(b))
            for j, b in enumerate(col_ids)
            if scores[i, j] > above and not (skip_self and a == b)
        ]
        if rows:
            out[int(a)] = [(b, -s + 0.0) for s, b in sorted(rows)[:k]]
    return out


@pytest.fixture
def vectors():
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(90, 6))
    matrix[30:60] = matrix[30]  # a third are copies
    matrix[75] = 0
    return matrix, rng.permutation(500)[:90]


@pytest.mark.parametrize("k", [3, 40])
@pytest.mark.parametrize("at_once", [7, 512])
def test_similar_by_factors(spark, vectors, monkeypatch, k, at_once):
    monkeypatch.setattr(strips, "RIGHT_ROWS_AT_ONCE", at_once)
    matrix, ids = vectors
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    units = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    got = ranked(latent.similar_by_factors(frame(spark, matrix, ids), k, above=0.2), "productId")
    assert got == best(units @ units.T, ids, ids, k, 0.2, True)
    assert int(ids[75]) not in got


@pytest.mark.parametrize("partitions", [4, 50_000])
@pytest.mark.parametrize("strip_rows, chunk_rows", [(1000, 1000), (10, 1000), (1000, 10), (7, 13)])
def test_any_tiling_gives_the_same(spark, vectors, monkeypatch, strip_rows, chunk_rows, partitions):
    monkeypatch.setattr(strips, "MAX_PARTITIONS", partitions)
    matrix, ids = vectors
    df = frame(spark, matrix, ids)
    tiled = top_by_product(
        df, df, 4, ["vec"], DenseStrip, 90, 90, above=0.0, strip_rows=strip_rows, chunk_rows=chunk_rows
    )
    assert ranked(tiled, "id") == best(matrix @ matrix.T, ids, ids, 4, 0.0, True)


def test_users_against_items(spark, vectors):
    matrix, ids = vectors
    users, items = frame(spark, matrix[:20], range(20)), frame(spark, matrix[20:], ids[20:])
    got = ranked(latent.score_top_k(users, items, 5), "userId")
    assert got == best(matrix[:20] @ matrix[20:].T, range(20), ids[20:], 5, 0.0, False)


def test_full_lists(spark, vectors, monkeypatch):
    monkeypatch.setattr(strips, "STRIP_ENTRIES", 300)
    matrix, ids = vectors
    users, items = frame(spark, matrix[:20], range(20)), frame(spark, matrix[20:], ids[20:])
    got = ranked(latent.score_top_k(users, items, 70, above=None), "userId")
    assert got == best(matrix[:20] @ matrix[20:].T, range(20), ids[20:], 70, -np.inf, False)


def test_als_lists(spark, ratings_of):
    rng = np.random.default_rng(1)
    rows = [(int(u) - 20, int(i), float(s), n) for n, (u, i, s) in enumerate(
        zip(rng.integers(0, 40, 800), rng.integers(0, 30, 800), rng.integers(1, 6, 800)))]
    ratings = ratings_of(rows)
    catalogue = spark.range(25).selectExpr("id AS productId").union(spark.range(25))
    model = latent.fit_als(ratings, rank=8)
    first = ranked(latent.recommend_to_users(model, catalogue, 10), "userId")
    assert set(first) <= {r[0] for r in rows}
    for recs in first.values():
        ids, scores = [i for i, _ in recs], [s for _, s in recs]
        assert len(recs) <= 10 and len(set(ids)) == len(ids)
        assert all(0 <= i < 25 for i in ids)
        assert scores == sorted(scores, reverse=True) and min(scores) > 0
    # the predictions are the model's own
    user, (item, score) = next((u, r[0]) for u, r in first.items())
    one = spark.createDataFrame([(user, item)], "userId int, productId int")
    assert model.transform(one).first().prediction == pytest.approx(score, abs=1e-4)
    # a list as long as the catalogue holds every positive prediction
    full = ranked(latent.recommend_to_users(model, catalogue, 25), "userId")
    pairs = spark.createDataFrame([(u, i) for u in first for i in range(25)], "userId int, productId int")
    positive = [r for r in model.transform(pairs).collect() if r.prediction > 1e-6]
    assert sum(1 for recs in full.values() for _, r in recs if r > 1e-6) == len(positive)


def test_als_lists_equal_the_built_in_ones(spark, ratings_of):
    rng = np.random.default_rng(5)
    rows = [(int(u), int(i), float(s), 0) for u, i, s in zip(
        rng.integers(0, 50, 900), rng.integers(0, 40, 900), rng.normal(1, 3, 900))]
    model = latent.fit_als(ratings_of(rows), rank=6)
    catalogue = model.itemFactors.selectExpr("id AS productId")
    mine = ranked(latent.recommend_to_users(model, catalogue, 7), "userId")
    for row in model.recommendForAllUsers(7).collect():
        wanted = [(r.productId, r.rating) for r in row.recommendations if r.rating > 1e-6]
        got = [(i, r) for i, r in mine.get(row.userId, []) if r > 1e-6]
        assert [i for i, _ in got] == [i for i, _ in wanted]
        assert [r for _, r in got] == pytest.approx([r for _, r in wanted], abs=1e-4)


def test_als_takes_the_newest_of_repeated_ratings(spark, ratings_of):
    rows = latent.newest_per_pair(ratings_of([(1, 2, 5.0, 1), (1, 2, 3.0, 9), (1, 3, 4.0, 0)])).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 2, 3.0), (1, 3, 4.0)]


def test_residuals_by_hand(spark, ratings_of):
    rng = np.random.default_rng(8)
    rows = [(int(u), int(i), float(s), 0) for u, i, s in zip(
        rng.integers(0, 9, 300), rng.integers(0, 40, 300), rng.normal(1, 3, 300))]
    ratings = latent.newest_per_pair(ratings_of(rows))
    model = latent.fit_als(ratings, rank=4, dedupe=False)
    x = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    v = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    found = latent.user_residuals(ratings, model, 0.5)
    # a rating stays one row: none a component
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    own = defaultdict(list)
    for r in ratings.collect():
        own[r.userId].append((r.score, v[r.productId]))
    got = {r.userId: (r.n, r.residual, r.scale) for r in found.collect()}
    assert set(got) == set(own)
    for user, rated in own.items():
        pulled = sum((s - x[user] @ w) * w for s, w in rated) - 0.5 * len(rated) * x[user]
        scale = sum(abs(s * w) for s, w in rated)
        assert got[user] == (len(rated), pytest.approx(abs(pulled).max()), pytest.approx(scale.max()))
