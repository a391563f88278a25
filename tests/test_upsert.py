import random

import __spark_entry__ as entry
from shelfsense.operators.upsert import newest_ratings, update_users, upsert_ratings


def replay(base, updates, touch=False):
    """Apply updates one at a time in time order."""
    table = {}
    for u, p, s, t in sorted(base, key=lambda r: (r[3], r[2])):
        table[u, p] = (s, t)
    for u, p, s, t in sorted(updates, key=lambda r: (r[3], r[2])):
        old = table.get((u, p))
        table[u, p] = (s, t if touch or old is None else old[1])
    return {(u, p, s, t) for (u, p), (s, t) in table.items()}


def test_one_pass_equals_replay(ratings_of):
    rng = random.Random(4)

    def rows(n):
        return [(rng.randrange(6), rng.randrange(5), float(rng.randrange(1, 9)), rng.randrange(50)) for _ in range(n)]

    base, updates = rows(30), rows(40) + [(1, 1, float(n % 7), 100 + n) for n in range(60)]
    for touch in (False, True):
        got = upsert_ratings(newest_ratings(ratings_of(base)), ratings_of(updates), touch).collect()
        wanted = replay(base, updates, touch)
        if touch:
            # a late update still marks the newest time seen
            newest = {}
            for u, p, _, t in base + updates:
                newest[u, p] = max(t, newest.get((u, p), t))
            by_update = {}
            for u, p, s, t in sorted(updates, key=lambda r: (r[3], r[2])):
                by_update[u, p] = (s, t)
            wanted = {
                (u, p, *(by_update.get((u, p)) or (s, t))) for u, p, s, t in wanted
            }
        assert {tuple(r) for r in got} == wanted
        assert len(got) == len(wanted)


def test_known_pair_keeps_its_time(ratings_of):
    base, updates = ratings_of([(1, 2, 3.0, 10)]), ratings_of([(1, 2, 5.0, 99), (4, 4, 1.0, 50)])
    assert sorted(tuple(r) for r in upsert_ratings(base, updates).collect()) == [(1, 2, 5.0, 10), (4, 4, 1.0, 50)]
    assert (1, 2, 5.0, 99) in {tuple(r) for r in upsert_ratings(base, updates, touch_ts=True).collect()}


def test_users_are_updated_never_inserted(spark):
    users = spark.createDataFrame(
        [(1, "ann", True, 5, None), (2, "bob", True, 6, ["x"])],
        "userId int, username string, first boolean, created_ms bigint, prefGenres array<string>",
    )
    updates = spark.createDataFrame(
        [(1, False, ["a"], 10), (1, False, ["b", "c"], 11), (3, False, ["z"], 12)],
        "userId int, first boolean, prefGenres array<string>, updated_ms bigint",
    )
    assert sorted(tuple(r) for r in update_users(users, updates).collect()) == [
        (1, "ann", False, 5, ["b", "c"]),
        (2, "bob", True, 6, ["x"]),
    ]


def test_base_is_neither_sorted_nor_grouped(spark, ratings_of):
    base = ratings_of([(1, 2, 3.0, 10)])
    plan = upsert_ratings(base, ratings_of([(4, 4, 1.0, 50)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2  # of the updates, once for each join
    once = newest_ratings(base)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in once and "HashAggregate" in once


def test_registered_upserts_have_one_row_a_pair(spark, ratings_of, monkeypatch):
    old, new = entry._SPLIT - 100, entry._SPLIT + 100
    rows = [(1, 2, 3.0, old), (1, 2, 4.0, old + 1), (1, 2, 2.0, old + 1), (1, 3, 5.0, old), (1, 3, 6.0, old + 2)]
    rows += [(1, 2, 8.0, new), (1, 2, 7.0, new + 1), (9, 9, 1.0, new)]
    monkeypatch.setattr(entry.B, "event_ratings", lambda *_: ratings_of(rows))
    for name, time in (("rating_upsert", old + 1), ("rating_upsert_touch", new + 1)):
        got = sorted(tuple(r) for r in entry.queries()[name](spark, "").collect())
        assert got == [(1, 2, 7.0, time), (1, 3, 6.0, old + 2), (9, 9, 1.0, new)]
    base, _ = entry._base_and_updates(spark, "")  # also that of stream_upsert
    assert sorted(tuple(r) for r in base.collect()) == [(1, 2, 4.0, old + 1), (1, 3, 6.0, old + 2)]
