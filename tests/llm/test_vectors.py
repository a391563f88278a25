import numpy as np
import pytest

from shelfsense.llm import vectors


def brute(rows, least=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([rows[i][1] for i in ok], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    links, component = {}, {}
    for k, i in enumerate(ok):
        if i not in component:
            todo, seen = [k], {k}
            while todo:
                for m in np.flatnonzero(near[todo.pop()]):
                    if m not in seen:
                        seen.add(m)
                        todo.append(m)
            ids = [rows[ok[m]][0] for m in seen if rows[ok[m]][0] is not None]
            component |= {ok[m]: min(ids, default=None) for m in seen}
        links[i] = int(near[k].sum())
    return [(r[0], links.get(i, 0), component.get(i, r[0])) for i, r in enumerate(rows)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 50)
    pick = np.random.default_rng(0)
    rows = []

    def add(v):
        rows.append((len(rows) * 2 + 1, [float(x) for x in v]))

    for _ in range(300):
        add(pick.normal(size=16))
    for size in (2, 3, 40, 180):  # groups, the largest longer than a window
        centre = pick.normal(size=16)
        for _ in range(size):
            add(centre + 0.12 * pick.normal(size=16))
    rows += [(9000 + i, rows[3][1]) for i in range(30)] + [(9100, [3 * x for x in rows[3][1]]), (9000, rows[3][1])]
    rows += [(8000, None), (8001, [0.0] * 16), (8002, [None, *[1.0] * 15]), (8003, [float("nan")] * 16), (8004, [float("inf")] * 16), (8000, None)]
    rows += [(None, rows[5][1]), (None, [1e200] * 16), (7001, [1e-200] * 15 + [-1e-200])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, h string")
    got = vectors.near_duplicates(frame).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    wanted = sorted(brute(rows), key=key)
    assert sorted(((r.id, r.n_links, r.component_id) for r in got), key=key) == wanted
    assert all(r.kept == (r.id == r.component_id) for r in got)
    assert vectors.near_duplicates(frame.limit(0)).collect() == []


def test_recall_on_pairs_at_the_threshold(spark):
    pick = np.random.default_rng(2)
    rows = []
    for i in range(1500):
        a = pick.normal(size=32)
        b = pick.normal(size=32)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        cosine = pick.uniform(0.951, 0.97)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.near_duplicates(frame).where("n_links > 0").count()
    assert got >= 0.9 * len(rows)


@pytest.mark.parametrize("n, mutual", [(9000, 0.8), (15_000, 0.9)])
def test_recall_in_a_hot_cluster(spark, n, mutual):
    pick = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    pairs, cosine = 400, 0.955
    centre = unit(pick.normal(size=(1, 64)))
    hot = unit(np.sqrt(mutual) * centre + np.sqrt(1 - mutual) * unit(pick.normal(size=(n // 3, 64))))
    apart = pick.normal(size=(pairs, 64))
    apart -= (hot[:pairs] * apart).sum(1, keepdims=True) * hot[:pairs]
    hot[pairs : 2 * pairs] = cosine * hot[:pairs] + np.sqrt(1 - cosine**2) * unit(apart)
    rows = np.vstack([hot, unit(pick.normal(size=(n - len(hot), 64)))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.id: r.component_id for r in vectors.near_duplicates(frame).where("n_links > 0").collect()}
    found = sum(got.get(i, -1) == got.get(i + pairs, -2) for i in range(pairs))
    assert found >= 0.97 * pairs


def test_vectors_of_unequal_length(spark):
    pick, rows = np.random.default_rng(6), []
    for i in range(120):
        v = [float(x) for x in pick.normal(size=3 + i % 4)]
        rows += [(3 * i, v), (3 * i + 1, [*v, 0.0, 0.0]), (3 * i + 2, [*v, 9.0])]
    width = max(len(v) for _, v in rows)
    wanted = brute([(i, [*v, *[0.0] * (width - len(v))]) for i, v in rows])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.near_duplicates(frame).collect()
    assert sorted((r.id, r.n_links, r.component_id) for r in got) == sorted(wanted)
