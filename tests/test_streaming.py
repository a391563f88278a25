import random

import pytest
from pyspark.sql import functions as F

from shelfsense.functions.scalars import rating_event
from shelfsense.operators import popularity, recent
from shelfsense.operators.upsert import upsert_ratings
from shelfsense.shared import run_dir
from shelfsense.sources import text
from shelfsense.streaming.recent import compact_recent_lists, current_recent_lists, start_recent_lists
from shelfsense.streaming.statistics import compact_statistics, current_statistics, start_statistics
from shelfsense.streaming.updates import compact_ratings, current_ratings, start_rating_updates


def rating_rows(n=300):
    """Half of the rows by one user."""
    rng = random.Random(2)
    return [(1 if rng.random() < 0.5 else rng.randrange(9), rng.randrange(20), rng.randrange(1, 11) / 2, rng.randrange(400))
            for _ in range(n)]


@pytest.fixture(params=["in order", "shuffled"])
def logged(request, spark, ratings_of):
    """(ratings, folder): the ratings as log files, by time or in any order."""
    rows = rating_rows()
    if request.param == "in order":
        rows.sort(key=lambda r: r[3])
    path = run_dir(spark, "test-log")
    event = rating_event(F.col("userId"), F.col("productId"), F.col("score"), F.col("ts"))
    for n in range(3):
        part = ratings_of(rows[n * 100 : n * 100 + 100])
        lines = part.select(F.explode(F.array(F.concat(F.lit("INFO : "), event), F.lit("noise"))).alias("value"))
        lines.coalesce(1).write.mode("append").text(path)
    return ratings_of(rows), path


def test_recent_lists(spark, logged):
    ratings, path = logged
    base = run_dir(spark, "test-stream")
    stream = text.stream_rating_log(spark, path, files_per_batch=1)
    query = start_recent_lists(stream, f"{base}/out", f"{base}/state", n=40, available_now=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    got = {r.userId: [tuple(x) for x in r.recent] for r in current_recent_lists(spark, f"{base}/out").collect()}
    wanted = {r.userId: [tuple(x) for x in r.recent] for r in recent.recent_lists(ratings, 40).collect()}
    assert got == wanted
    assert len(got[1]) == 40
    compact_recent_lists(spark, [f"{base}/out"], f"{base}/compact")
    again = {r.userId: [tuple(x) for x in r.recent] for r in current_recent_lists(spark, f"{base}/compact").collect()}
    assert again == wanted
    assert current_recent_lists(spark, f"{base}/out", f"{base}/compact").count() == len(wanted)


def test_updates(spark, logged, ratings_of):
    ratings, path = logged
    base = run_dir(spark, "test-stream")
    stream = text.stream_rating_log(spark, path, files_per_batch=1)
    start_rating_updates(stream, f"{base}/out", f"{base}/state", available_now=True).awaitTermination()
    old = ratings_of([(1, 1, 0.5, 1000), (77, 1, 0.5, 1000)])
    got = sorted(tuple(r) for r in current_ratings(spark, old, f"{base}/out").collect())
    assert got == sorted(tuple(r) for r in upsert_ratings(old, ratings).collect())
    compact_ratings(spark, old, f"{base}/out", f"{base}/snapshot")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{base}/snapshot").collect()) == got


def test_queue_drops_the_oldest(ratings_of):
    ratings = ratings_of([(1, n, 1.0, n) for n in range(41)])
    rows = recent.recent_ratings(ratings).orderBy("pos").collect()
    assert [r.productId for r in rows] == list(range(40, 0, -1))
    entry = recent.queue_entries(recent.recent_ratings(ratings, 1)).first()
    assert tuple(entry) == ("userId:1", 1, "40:1.0")
    assert recent.unnest_recent(recent.recent_lists(ratings, 3)).count() == 3


def test_statistics(spark, logged):
    ratings, path = logged
    base = run_dir(spark, "test-statistics")
    stream = text.stream_rating_log(spark, path, files_per_batch=1)
    query = start_statistics(stream, f"{base}/out", f"{base}/state", available_now=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3

    def rows(frame):
        return sorted(tuple(r) for r in frame.collect())

    wanted = rows(popularity.rate_more(ratings).join(popularity.average_scores(ratings), "productId"))
    compact_statistics(spark, [f"{base}/out"], f"{base}/compact")
    twice = current_statistics(spark, f"{base}/out", f"{base}/compact").select("yearmonth", "productId", "count")
    assert rows(twice) == [(m, p, 2 * n) for m, p, n in rows(popularity.rate_more_recently(ratings))]
    for out in ("out", "compact"):
        partials = current_statistics(spark, f"{base}/{out}")
        assert rows(popularity.statistics_of(partials)) == wanted
        assert rows(partials.select("yearmonth", "productId", "count")) == rows(popularity.rate_more_recently(ratings))


def test_partial_statistics_without_scores_or_products(spark):
    ratings = spark.createDataFrame([(1, None, 0), (None, 2.0, 0), (2, 1.0, 0), (2, None, 0), (2, 4.0, 9**8)], "productId int, score double, ts long")
    halves = [popularity.partial_statistics(ratings.where(f"coalesce(score, 0) {sign} 2")) for sign in ("<", ">=")]
    got = popularity.statistics_of(popularity.merged_statistics(halves[0].unionByName(halves[1])))
    assert {tuple(r) for r in got.collect()} == {(1, 1, None), (None, 0, 2.0), (2, 3, 2.5)}
    assert popularity.statistics_of(popularity.partial_statistics(ratings.limit(0))).collect() == []
