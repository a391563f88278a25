import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfsense.llm import exact


def brute(rows, keep, norm=lambda t: t):
    """{(id, text): (keep_id, size)}, and the ids that stay."""
    of = defaultdict(list)
    for i, t in rows:
        of[norm(t or "")].append(i)
    best = {t: (max if keep == "largest" else min)([i for i in ids if i is not None], default=None) for t, ids in of.items()}
    return {(i, t): (best[norm(t or "")], len(of[norm(t or "")])) for i, t in rows}


def table(n, seed):
    pick = random.Random(seed)
    hot = "the same long passage, again and again " * 30
    texts = [None, "", " ", "a", "A", "ä", "ä", "😀", "x" * 64 + "1", "x" * 64 + "2", "x" * 64, hot, "w " * 400_000]
    rows = [(i, hot if i % 3 == 0 else pick.choice(texts + [f"own {i}"] * 12)) for i in range(n)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("part_rows", [1, 3, 1000])
def test_against_brute_force(spark, keep, part_rows):
    rows = table(300, part_rows)
    docs = spark.createDataFrame([(*r, "h", 1, True) for r in rows], "doc_id long, text string, h string, part int, kept boolean")
    got = exact.groups(docs.repartition(7), keep=keep, part_rows=part_rows).collect()
    assert len(got) == len(rows)
    wanted, text = brute(rows, keep), dict(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == wanted[r.id, text[r.id]]
        assert r.kept == (r.id == r.keep_id)
    import hashlib

    assert all(r.text_sha256 == hashlib.sha256((text[r.id] or "").encode()).hexdigest() for r in got)


def test_normalised_texts(spark):
    rows = table(80, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact.groups(docs, normalise=lambda t: F.lower(F.trim(t))).collect()
    wanted, text = brute(rows, "smallest", lambda t: t.strip(" ").lower()), dict(rows)
    assert all((r.keep_id, r.group_size) == wanted[r.id, text[r.id]] for r in got)


@pytest.mark.parametrize("part_rows", [1, 1000])
def test_repeated_rows_null_ids_and_an_empty_table(spark, part_rows):
    rows = [(5, "a")] * 4 + [(None, "a")] * 2 + [(None, "n")] * 3 + [(1, "a"), (7, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for keep, stays in (("largest", 5), ("smallest", 1)):
        got = exact.groups(docs, keep=keep, part_rows=part_rows).collect()
        assert sorted((r.id, r.keep_id) for r in got if r.kept and r.id is not None) == [(stays, stays), (7, 7)]
        assert [r.keep_id for r in got if r.kept and r.id is None] == [None]
        assert {r.group_size for r in got} == {7, 3, 1} and sum(r.kept for r in got) == 3
    nothing = exact.groups(docs.limit(0), part_rows=part_rows)
    assert nothing.count() == 0 and nothing.columns == ["id", "keep_id", "group_size", "kept", "text_sha256"]
    with pytest.raises(ValueError, match="keep"):
        exact.groups(docs, keep="newest")


def test_texts_are_shuffled_once_by_range_and_never_sampled_whole(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(exact, "settled", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), df)[1])
    exact.groups(spark.createDataFrame(table(30, 1), "doc_id long, text string"))
    shuffles = [x for x in plans[0].splitlines() if "Exchange" in x and "Broadcast" not in x]
    by_range = [x for x in shuffles if "rangepartitioning" in x]
    assert len(by_range) == 1 and "leading" in by_range[0] and "t#" not in by_range[0].split("rangepartitioning(")[1].split("part#")[0].replace("leading#", "")
    # the only other one carries hashes and their counts
    assert all("hashpartitioning(h" in x for x in shuffles if x not in by_range)
    assert "Python" not in plans[0] and "Arrow" not in plans[0]
