import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfsense.operators import corating


def brute_force(pairs, k, dedupe):
    """Best k per item from (user, item) rows, by counting all pairs."""
    times = Counter(pairs)
    if dedupe:
        times = Counter(set(pairs))
    baskets, raters = defaultdict(dict), Counter()
    for (user, item), n in times.items():
        baskets[user][item] = n
        raters[item] += n
    both = Counter()
    for basket in baskets.values():
        for a, na in basket.items():
            for b, nb in basket.items():
                if a != b:
                    both[a, b] += na * nb
    lists = defaultdict(list)
    for (a, b), n in both.items():
        lists[a].append((-n / math.sqrt(raters[a] * raters[b]), b))
    best = {a: [(b, -s) for s, b in sorted(rows)[:k]] for a, rows in lists.items()}
    return best, {(a, b): (n, raters[a], raters[b]) for (a, b), n in both.items()}


def skewed(seed, users=40, items=60, n=900):
    """A third of the rows by one user, a third on one item, with repeated pairs."""
    rng = random.Random(seed)
    rows = [(0, rng.randrange(items)) for _ in range(n // 3)]
    rows += [(rng.randrange(users), 7) for _ in range(n // 3)]
    rows += [(rng.randrange(users), rng.randrange(items)) for _ in range(n // 3)]
    return rows


def ranked(df):
    lists = defaultdict(list)
    for row in df.orderBy("productId", "rank").collect():
        lists[row.productId].append((row.rid, row.r))
    return dict(lists)


LAYOUTS = [(None, None), (8, None), (8, 3), (1, 5), (100, 1)]


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("part_items, tasks", LAYOUTS)
def test_equals_brute_force(spark, ratings_of, dedupe, part_items, tasks):
    rows = skewed(part_items)
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in rows])
    best, pairs = brute_force(rows, 5, dedupe)
    got = ranked(corating.similar_by_co_rating(ratings, 5, dedupe, part_items, tasks))
    assert got == best
    counted = corating.co_rating_counts(ratings, dedupe, part_items, tasks).collect()
    assert {(r.product1, r.product2): (r.common, r.nor1, r.nor2) for r in counted} == pairs
    assert len(counted) == len(pairs)


@pytest.mark.parametrize("limit", [1, 50, 1000])
def test_steps_of_any_size(spark, ratings_of, monkeypatch, limit):
    monkeypatch.setattr(corating, "PAIRS_AT_ONCE", limit)
    rows = skewed(6)
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in rows])
    for dedupe in (True, False):
        got = ranked(corating.similar_by_co_rating(ratings, 3, dedupe, 16))
        assert got == brute_force(rows, 3, dedupe)[0]


def tiled(monkeypatch):
    """Has lists of similar items made by tiles, which a call with a path of its own would not."""
    seen = []
    real = corating._tiles
    monkeypatch.setattr(corating, "_tiles", lambda *a: (seen.append(a[-1]), real(*a))[1])
    return seen


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("block_entries, limit", [(1000, 1000), (100, 1), (300, 50)])
def test_tiles_equal_brute_force(spark, ratings_of, monkeypatch, dedupe, block_entries, limit):
    monkeypatch.setattr(corating, "BLOCK_ENTRIES", block_entries)
    monkeypatch.setattr(corating, "PAIRS_AT_ONCE", limit)
    monkeypatch.setattr(corating, "BATCH_ROWS", 7)
    seen = tiled(monkeypatch)
    rows = [(u - 5, i * 10**15 - 3) for u, i in skewed(block_entries, users=300, items=200, n=3000)]
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in rows] + [(None, 1, 1.0, 0), (1, None, 1.0, 0)])
    got = ranked(corating.similar_by_co_rating(ratings, 3, dedupe, tasks=4))
    assert got == brute_force(rows, 3, dedupe)[0]
    assert len(seen) == 1 and seen[0] >= 3


def test_different_pairs_stay_in_their_task(spark, ratings_of, monkeypatch):
    """Baskets of forty among four thousand items: nearly every pair occurs once, and few leave a task."""
    seen = tiled(monkeypatch)
    rng = random.Random(3)
    rows = [(u, rng.randrange(4000)) for u in range(1500) for _ in range(40)]
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in rows])
    best, pairs = brute_force(rows, 5, True)
    assert ranked(corating.similar_by_co_rating(ratings, 5)) == best
    handed_on = corating._best_pairs(ratings, 5, True, None, None).count()
    assert seen and handed_on < 0.2 * len(pairs) / 2


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {files.apply(i).getName() for i in range(files.length()) if files.apply(i).getName().startswith("shuffle")}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_more_blocks_than_items_in_a_basket(spark, ratings_of, monkeypatch, adaptive):
    """Baskets of twelve among 400 items in over 30 blocks, by passes: lists leave a task, and no pass keeps its files."""
    monkeypatch.setattr(corating, "BLOCK_ENTRIES", 1500)
    monkeypatch.setattr(corating, "PASS_ENTRIES", 10_000, raising=False)
    monkeypatch.setattr(corating, "PASS_SHARE", 1, raising=False)
    rng = random.Random(8)
    rows = [(u, rng.randrange(400)) for u in range(400) for _ in range(12)]
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in rows])
    best, pairs = brute_force(rows, 5, True)
    before = shuffle_files(spark)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        best_pairs = corating._best_pairs(ratings, 5, True, None, None)
        # what the sizes of the inputs were added up from is a few rows a query
        left = shuffle_files(spark) - before
        assert best_pairs.count() < 0.2 * len(pairs) / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len({name.split("_")[1] for name in left}) <= 4
    assert ranked(corating.similar_by_co_rating(ratings, 5)) == best


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("passes", [1, 10**9])
def test_baskets_in_pieces_equal_brute_force(spark, ratings_of, monkeypatch, dedupe, passes):
    """Baskets cut for tiles, and a block of an item with many raters shared out, within a pass and over several."""
    monkeypatch.setattr(corating, "PIECE_ITEMS", 5)
    monkeypatch.setattr(corating, "BLOCK_ENTRIES", 1000)
    monkeypatch.setattr(corating, "ENTRIES_PER_ROW", 700)
    monkeypatch.setattr(corating, "PASS_ENTRIES", passes)
    monkeypatch.setattr(corating, "PASS_SHARE", 2)
    seen = tiled(monkeypatch)
    rows = [(u, i - 100) for u, i in skewed(passes, users=200, items=150, n=2400)]
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in rows]).selectExpr("concat('u', userId) AS userId", "productId")
    got = ranked(corating.similar_by_co_rating(ratings, 3, dedupe, tasks=4))
    assert got == brute_force(rows, 3, dedupe)[0]
    assert len(seen) == 1


@pytest.mark.parametrize("apart", [1, 10**14])
def test_memory_of_a_tile_is_bounded(apart):
    """A tile of 200,000 baskets of forty items, of which one is of its block: eight million entries."""
    baskets, size = 200_000, 40
    n_items = 40_000
    rng = np.random.default_rng(1)

    def batches():
        for _ in range(20):
            item = rng.integers(0, n_items, (baskets // 20, size)).astype(np.uint64) * np.uint64(apart)
            item[:, 0] = rng.integers(0, 300, len(item)).astype(np.uint64) * np.uint64(apart)
            n, raters = np.full(len(item), size), np.full(len(item), 50)
            columns = [np.ones(len(item), int), item[:, 0], raters, None, n, item.ravel(), np.full(item.size, 50), None]
            yield corating._batch([[None if c is None else corating._bytes(c) for c in columns]])

    held, found = 0, []
    tracemalloc.start()
    try:
        for batch in corating.best_of_tile(5, corating.PAIRS_AT_ONCE, 0)(batches()):
            held = max(held, pa.total_allocated_bytes())
            found.append(batch.num_rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(found) == 300 * 5
    assert peak + held < (300e6 if apart == 1 else 700e6)


def test_few_users_are_listed(spark, ratings_of, monkeypatch):
    """A list of users cut in parts that may hold only two of them: the others keep whole baskets."""
    monkeypatch.setattr(corating, "MOST_HEAVY", 2)
    rows = skewed(4)
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in rows])
    assert ranked(corating.similar_by_co_rating(ratings, 5, True, 3)) == brute_force(rows, 5, True)[0]


def test_a_heavy_basket_is_spread(spark, ratings_of):
    """One user with all ratings of 900 items: no task gets more than a few pairs of parts."""
    ratings = ratings_of([(1, i, 1.0, 0) for i in range(900)])
    baskets = corating._baskets(corating._incidence(ratings, True), 50, 30)
    work = baskets.select(
        F.spark_partition_id().alias("task"),
        F.expr("CASE WHEN size(r) = 0 THEN size(l) * (size(l) - 1) / 2 ELSE size(l) * size(r) END").alias("pairs"),
        F.greatest(F.size("l"), F.size("r")).alias("items"),
    )
    by_task = [r["n"] for r in work.groupBy("task").agg(F.sum("pairs").alias("n")).collect()]
    assert sum(by_task) == 900 * 899 / 2
    assert max(by_task) < 0.15 * sum(by_task) and len(by_task) > 20
    assert work.agg(F.max("items")).first()[0] < 100


def test_fewer_rows_are_shuffled_than_pairs_counted(spark):
    """A million items, popular ones among them, in baskets of 24 (244 blocks of 4,096 items)."""
    ratings = spark.range(0, 240_000, 1, 8).selectExpr(
        "id % 10000 AS userId",
        "CASE WHEN id % 24 < 12 THEN pmod(xxhash64(id), 60) ELSE pmod(xxhash64(id), 1000000) END AS productId",
        "1.0D AS score",
        "id AS ts",
    )
    incidence = corating._incidence(ratings, True)
    emitted = incidence.groupBy("userId").count().selectExpr("sum(count * (count - 1))").first()[0]
    shuffled = corating.partial_pairs(ratings).count()
    distinct = corating.co_rating_counts(ratings).count()
    # both directions of a pair are one row, and repeated pairs are one a task at most
    assert distinct / 2 <= shuffled < 0.42 * emitted


@pytest.mark.parametrize("size, rows", [(60, 6_000), (2, 3_000_000)])
def test_memory_of_a_task_is_bounded(size, rows):
    """Ten million pairs in baskets of sixty items, and baskets of two items, which have few pairs for their size."""
    entry = pa.struct([("item", pa.int64()), ("raters", pa.int64()), ("w", pa.int64())])

    def batches():
        for start in range(0, rows, 10_000):
            n = min(10_000, rows - start)
            flat = np.arange(n * size) % 977
            entries = pa.StructArray.from_arrays([pa.array(flat)] + [pa.array(np.ones(len(flat), np.int64))] * 2, fields=list(entry))
            left = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), entries)
            right = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), entries.slice(0, 0))
            yield pa.RecordBatch.from_arrays([left, right], ["l", "r"])

    held, total = 0, 0
    tracemalloc.start()
    try:
        for batch in corating.partial_counts(False, corating.PAIRS_AT_ONCE)(batches()):
            held = max(held, pa.total_allocated_bytes())
            total += sum(batch.column("common").to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == rows * size * (size - 1) // 2
    assert peak + held < 250e6


def test_golden(spark, ratings_of):
    ratings = ratings_of([(u, i, 1.0, 0) for u, i in [(1, 10), (1, 20), (2, 10), (2, 20), (3, 10)]])
    assert ranked(corating.similar_by_co_rating(ratings)) == {
        10: [(20, pytest.approx(0.816497, abs=1e-6))],
        20: [(10, pytest.approx(0.816497, abs=1e-6))],
    }


def test_duplicates(spark, ratings_of):
    ratings = ratings_of([(1, 10, 1.0, 0), (1, 10, 1.0, 1), (1, 20, 1.0, 0)])
    assert ranked(corating.similar_by_co_rating(ratings))[10] == [(20, 1.0)]
    assert ranked(corating.similar_by_co_rating(ratings, dedupe=False))[10] == [
        (20, pytest.approx(math.sqrt(2)))
    ]


def test_ties_go_to_the_smaller_id(spark, ratings_of):
    ratings = ratings_of([(1, i, 1.0, 0) for i in (9, 7, 3, 5)])
    assert ranked(corating.similar_by_co_rating(ratings, 2))[9] == [(3, 1.0), (5, 1.0)]


def test_nothing_in_nothing_out(spark, ratings_of):
    assert corating.similar_by_co_rating(ratings_of([])).collect() == []
    assert corating.similar_by_co_rating(ratings_of([(1, 1, 1.0, 0)])).collect() == []


def test_plan(spark, ratings_of):
    ratings = spark.range(1000).selectExpr(
        "id % 50 AS userId", "id % 333 AS productId", "1.0D AS score", "id AS ts"
    )
    df = corating.similar_by_co_rating(ratings, 5, True, 64)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("MapInArrow") == 1
    for bad in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    # partial counts are added up by Spark, before and after the shuffle, and mirrored only then
    above = plan[: plan.index("MapInArrow")]
    assert "partial_sum(common" in above and above.index("Generate explode") < above.index("partial_sum(common")
    assert df.agg(F.max("rank")).first()[0] <= 5
