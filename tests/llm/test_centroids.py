import hashlib

import numpy as np
import pytest

from shelfsense.llm import centroids


def brute(ids, rows, k, rounds, seed="2"):
    drawn = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"{seed}:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), rows[i]))
    c = [list(rows[i]) for i in drawn[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        of = [nearest(x)[1] for x in rows]
        for j in range(len(c)):
            own = [x for x, o in zip(rows, of, strict=True) if o == j]
            if own:
                c[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return [nearest(x) for x in rows], c


def integers(vector, scale):
    return [int(np.floor(float(np.float32(x)) * scale)) for x in vector]


@pytest.mark.parametrize("spread, offset", [(0.05, 0.0), (0.5, 0.0), (0.001, 1000.0)])
def test_against_brute_force(spark, spread, offset):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    vectors = [list(map(float, (centres[i % 6] + rng.normal(scale=spread, size=8) + offset).astype(np.float32))) for i in range(240)]
    vectors += [vectors[0]] * 80 + [[0.0] * 8] * 3  # a third are copies
    odd = [None, [], [1.0] * 7, [1.0] * 9, [1.0] * 7 + [None], [1.0] * 7 + [float("nan")], [1.0] * 7 + [float("-inf")]]
    data = [(None if i == 11 else i, v, 1, "x") for i, v in enumerate(vectors + odd)] + [(5, vectors[5], 1, "x")]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, cluster int, q string").repartition(5)
    sound = [(i, integers(v, 256)) for i, v, *_ in data if v is not None and len(v) == 8 and None not in v and np.isfinite(v).all()]
    wanted, final = brute([i for i, _ in sound], [v for _, v in sound], 9, 3)
    found, got = centroids.cluster(frame, components=8, k=9, rounds=3, leading=3)
    assert got.tolist() == final
    rows = found.collect()
    assert sorted((str(i), c, d) for (i, _), (d, c) in zip(sound, wanted, strict=True)) == sorted(
        (str(r.id), r.cluster, r.distance) for r in rows
    )
    total = sum(d for d, _ in wanted)
    for r in rows:
        assert r.inertia == total and r.cluster_inertia == sum(d for d, c in wanted if c == r.cluster)


def test_bounds_spare_most_distances_and_lose_none():
    rng = np.random.default_rng(1)
    centres = rng.normal(scale=100, size=(40, 64)) * np.linspace(1, 0.05, 64)
    rows = np.floor(centres[rng.integers(0, 40, 3000)] + rng.normal(scale=6, size=(3000, 64))).astype(np.int64)
    mean = rows.mean(0)
    basis = np.linalg.eigh(np.cov(rows.T))[1][:, ::-1]
    turn = centroids.Rotation(mean, basis, 16)
    c = np.vstack([rows[:39], rows[:1]])  # the last one ties with the first
    lead, rest, _ = turn.turned(rows.astype(float))
    best, distance, verified = centroids.nearest(rows, lead.astype(np.float32), rest.astype(np.float32), c, turn)
    every = ((rows[:, None] - c[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert verified < 0.2 * every.size


def test_extremes(spark):
    frame = spark.createDataFrame([(1, [1e30] * 4), (2, [0.0] * 4)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="would not fit a long"):
        centroids.cluster(frame, components=4)
    large = spark.createDataFrame([(1, [5e5] * 4), (2, [-5e5] * 4)], "vec_id long, embedding array<double>")
    found, _ = centroids.cluster(large, components=4, k=1, rounds=1)
    assert sorted(r.distance for r in found.collect()) == [4 * (256 * 500_000) ** 2] * 2
    nothing, none = centroids.cluster(frame.limit(0), components=4)
    assert nothing.count() == 0 and len(none) == 0
    assert nothing.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia"]
