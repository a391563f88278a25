import numpy as np
import pytest

from shelfsense.llm import codes


def brute(data, parts, entries, rounds, scale=1024):
    """{position in data: (codes, error)} and the codebooks of rows (id, vector)."""
    q = [[int(np.floor(float(np.float32(x)) * scale)) for x in v] for _, v in data]
    width = -(-len(q[0]) // parts)
    q = [v + [0] * (parts * width - len(v)) for v in q]
    first = sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0] or 0, q[i]))[:entries]
    out, books = [([], 0) for _ in data], []
    for p in range(parts):
        rows = [v[p * width : (p + 1) * width] for v in q]
        book = [list(rows[i]) for i in first]

        def nearest(x):
            return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), j) for j, y in enumerate(book))

        for _ in range(rounds):
            of = [nearest(x)[1] for x in rows]
            for j in range(len(book)):
                own = [x for x, o in zip(rows, of, strict=True) if o == j]
                if own:
                    book[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
        out = [(c + [n[1]], e + n[0]) for (c, e), n in zip(out, map(nearest, rows), strict=True)]
        books.append(book)
    return out, books


@pytest.mark.parametrize("length, parts, entries", [(12, 4, 9), (10, 4, 5), (7, 1, 300), (4, 4, 3)])
def test_against_brute_force(spark, length, parts, entries):
    rng = np.random.default_rng(length)
    centres = rng.normal(size=(5, length))
    vectors = [list(map(float, (centres[i % 5] + rng.normal(scale=0.1, size=length)).astype(np.float32))) for i in range(120)]
    vectors += [vectors[0]] * 60  # a third are copies
    odd = [None, [], [1.0] * (length - 1), [2.0] * (length - 1) + [None], [1.0] * (length - 1) + [float("nan")], [float("inf")] * length]
    label = lambda i: None if i % 3 == 0 else i % 7
    data = [(None if i == 7 else i + 1, v, label(i), "x", 2) for i, v in enumerate(vectors + odd)] + [(3, vectors[2], 0, "x", 2)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, entries string, error int")
    sound = [(i, v, k) for i, v, k, *_ in data if v is not None and len(v) == length and None not in v and np.isfinite(v).all()]
    wanted, books = brute([(i, v) for i, v, _ in sound], parts, entries, 2)
    coded, got = codes.compress(frame.repartition(4), parts=parts, entries=entries, rounds=2)
    assert got.tolist() == books
    by_label = {}
    for (_, _, k), (_, e) in zip(sound, wanted, strict=True):
        by_label[k] = by_label.get(k, 0) + e
    rows = [(r.id, r.label, r.entries, r.error, r.label_error) for r in coded.collect()]
    assert sorted(rows, key=str) == sorted(
        ((i, k, c, e, by_label[k]) for (i, _, k), (c, e) in zip(sound, wanted, strict=True)), key=str
    )


def test_transform_keeps_distances_in_order_of_sequency():
    for width in (1, 2, 8, 16):
        matrix = codes.walsh(width)
        assert (matrix @ matrix.T == width * np.eye(width)).all()
        assert (np.diff(matrix) != 0).sum(1).tolist() == list(range(width))
    rng = np.random.default_rng(2)
    x, y = rng.integers(-500, 500, (2, 30, 13))
    a, b = (codes.transformed(z, 1)[:, 0] for z in (x, y))
    assert (((a - b) ** 2).sum(1) == 16 * ((x - y) ** 2).sum(1)).all()


def test_entries_are_eliminated_early_and_none_is_lost():
    rng = np.random.default_rng(4)
    smooth = rng.normal(scale=300, size=(2500, 16)).cumsum(1)
    points = codes.transformed(np.floor(smooth).astype(np.int64), 1)[:, 0]
    entries = np.vstack([points[:255], points[:1]])  # the last one ties with the first
    index, total, seen = codes.nearest(points, entries)
    every = ((points[:, None] - entries[None]) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (total == every.min(1)).all()
    assert seen < 0.4 * every.size * 16


def test_extremes(spark):
    frame = spark.createDataFrame([(1, [1e30] * 8, 1), (2, [0.0] * 8, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="would not fit a long"):
        codes.compress(frame)[0].collect()
    nothing, books = codes.compress(frame.limit(0))
    assert nothing.count() == 0 and books.shape[1] == 0
    assert nothing.columns == ["id", "label", "entries", "error", "label_error"]
    single, _ = codes.compress(frame.where("vec_id = 2"))
    assert [(r.entries, r.error) for r in single.collect()] == [([0] * 4, 0)]
