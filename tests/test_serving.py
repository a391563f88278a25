import pytest

from shelfsense.operators import popularity, ranking, serving


@pytest.fixture
def products(spark):
    rows = [(1, "red Ring", "c", "i", "t"), (2, "blue ring", "c", "i", "t"), (3, "bolt", "c", "i", "t")]
    return spark.createDataFrame(rows, "productId bigint, name string, categories string, imageUrl string, tags string")


def tuples(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_popularity(ratings_of):
    ratings = ratings_of(
        [(1, 1, 2.0, 1260759144), (2, 1, 4.0, 1260759144), (1, 2, 5.0, 1263437544), (1, 3, 5.0, 1263437544)]
    )
    assert sorted(tuples(popularity.rate_more(ratings), "productId", "count")) == [(1, 2), (2, 1), (3, 1)]
    monthly = popularity.rate_more_recently(ratings)
    assert sorted(tuples(monthly, "yearmonth", "productId", "count")) == [
        (200912, 1, 2), (201001, 2, 1), (201001, 3, 1),
    ]
    assert tuples(popularity.hot(monthly, 2), "productId") == [(2,), (3,)]
    assert tuples(popularity.most_rated(popularity.rate_more(ratings), 2), "productId") == [(1,), (2,)]
    averages = popularity.by_average(popularity.average_scores(ratings))
    assert tuples(averages, "productId", "avg") == [(2, 5.0), (3, 5.0), (1, 3.0)]
    assert sorted(tuples(popularity.distinct_users(ratings), "userId")) == [(1,), (2,)]


def test_unrated_products_score_zero(spark, products):
    averages = spark.createDataFrame([(1, 4.5)], "productId bigint, avg double")
    assert sorted(tuples(serving.with_score(products, averages), "productId", "score")) == [
        (1, 4.5), (2, 0.0), (3, 0.0),
    ]


def test_lists_keep_their_order_and_drop_unknown_products(spark, products):
    flat = spark.createDataFrame(
        [(9, 3, 0.9, 1), (9, 77, 0.8, 2), (9, 1, 0.7, 3), (8, 2, 0.5, 1)],
        "productId bigint, rid bigint, r double, rank int",
    )
    nested = ranking.nest_recs(flat, "productId")
    assert {r.productId: [x.rid for x in r.recs] for r in nested.collect()} == {9: [3, 77, 1], 8: [2]}
    requests = spark.createDataFrame([(9,), (9,), (404,)], "productId bigint")
    rows = serving.recs_for_products(requests, nested)
    averages = spark.createDataFrame([(1, 4.5)], "productId bigint, avg double")
    full = serving.enrich(rows, products, averages).orderBy("rank")
    assert tuples(full, "rank", "rid", "name", "score") == [(1, 3, "bolt", 0.0), (3, 1, "red Ring", 4.5)]
    assert serving.recs_for_products(requests, nested, first=1).count() == 1


def test_names_to_lists(spark):
    users = spark.createDataFrame([("ann", 5), ("bob", 6)], "username string, userId bigint")
    stream = spark.createDataFrame(
        [(5, [(1, 0.5), (2, 0.25)])], "userId bigint, recs array<struct<productId:bigint,score:double>>"
    )
    requests = spark.createDataFrame([("ann",), ("bob",), ("nobody",)], "username string")
    rows = serving.recs_for_usernames(requests, users, ranking.stream_recs_as_recs(stream))
    assert sorted(tuples(rows, "username", "rank", "rid", "r")) == [("ann", 1, 1, 0.5), ("ann", 2, 2, 0.25)]
    assert tuples(serving.user_by_name(users, "bob"), "userId") == [(6,)]


def test_search(products):
    assert tuples(serving.search(products, "ring"), "productId") == [(2,)]
    assert sorted(tuples(serving.search(products, "(?i)RING$"), "productId")) == [(1,), (2,)]
    many = serving.search(products, ["^b", "l"])
    assert sorted(tuples(many, "pattern", "productId")) == [("^b", 2), ("^b", 3), ("l", 2), ("l", 3)]


def test_lookups(spark, products, ratings_of):
    ids = spark.createDataFrame([(3,), (3,), (9,)], "productId bigint")
    assert tuples(serving.products_by_ids(products, ids), "productId") == [(3,)]
    assert tuples(serving.product_by_id(products, 2), "name") == [("blue ring",)]
    assert serving.product_by_id(products, 22).collect() == []
    ratings = ratings_of([(1, 2, 3.0, 10), (1, 2, 4.0, 20), (1, 3, 5.0, 20), (2, 2, 1.0, 5)])
    pairs = spark.createDataFrame([(1, 2), (9, 9)], "userId bigint, productId bigint")
    assert tuples(serving.ratings_of_pairs(ratings, pairs), "score", "ts") == [(4.0, 20)]
    assert sorted(tuples(serving.first_rating(ratings), "userId", "productId")) == [(1, 2), (2, 2)]


def test_search_by_a_table(spark, products):
    averages = spark.createDataFrame([(2, 4.5)], "productId bigint, avg double")
    patterns = spark.createDataFrame([("^b",), ("l",), ("l",), (None,), ("(?i)RED",), ("zzz",)], "pattern string")
    for block in (1, 32):
        got = serving.search_table(products, patterns, averages, block)
        assert sorted(tuples(got, "pattern", "productId", "score")) == [
            ("(?i)RED", 1, 0.0), ("^b", 2, 4.5), ("^b", 3, 0.0), ("l", 2, 4.5), ("l", 3, 0.0),
        ]
    assert serving.search_table(products, patterns.limit(0), averages).count() == 0


def test_requests_and_new_users(spark):
    users = spark.createDataFrame([("ann", 5)], "username string, userId int")
    requests = spark.createDataFrame(
        [("ann", 7, 9, 100), ("ann", 8, 1, 101), ("eve", 7, 3, 102), (None, 7, 3, 103)],
        "username string, productId bigint, stars int, ts bigint",
    )
    assert sorted(map(tuple, serving.ratings_from_requests(requests, users).collect())) == [
        (5, 7, 4.5, 100), (5, 8, 0.5, 101),
    ]
    added = serving.new_users(requests, users).collect()
    assert [(r.username, r.first) for r in added] == [("eve", True)]
    assert added[0].created_ms > 1_600_000_000_000 and added[0].userId == 100820
