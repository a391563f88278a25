"""Integer centroid clustering with PCA-rotated filtering.

Components become integers, and all that decides is reckoned in integers: distances, sums and floors of means. Floating
point only spares distances. A principal-component rotation of all vectors is learnt from one grouped sum of products;
each vector is stored with its ``LEADING`` rotated coordinates and the norm of the rest. For a vector and a centroid
the distance of the leading coordinates and the difference of the two residual norms, squared and added, never exceed
the squared distance, so a centroid whose bound (less a margin for rounding) is above the distance of the centroid
with the smallest bound cannot be nearest. The others are verified in integers, ties going to the smaller number.

A round is one pass over the stored vectors that hands on a row a task and cluster, the sums as exact decimals; only
the centroids (their number times their components) come to the driver and go out again.

Vectors that are null, of another length, or hold null or non-finite components are left out. Integers beyond
``LARGEST`` stop the job with a message, as their squared distances do not fit a long. A null id hashes as an empty
one; repeated rows are vectors like others; rows of equal ids are told apart by their components when centroids are
chosen. Fewer vectors than centroids wanted give as many centroids as vectors; an empty table an empty result. Other
columns are not read, so their names may clash with those used here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.shared import settled

#: Rotated coordinates kept; the largest integer component; pairs verified at once; share of two norms, and distance
#: besides, that rounding of the stored numbers, which are single precision, stays well below.
LEADING, LARGEST, AT_ONCE, MARGIN, LEAST_MARGIN = 16, 2**27, 32_768, 1e-6, 2.0**-10


def usable(vector: Column, components: int | None) -> Column:
    """Whether a vector has the wanted length (any, if None) and finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sized = F.size(vector) == components if components else F.size(vector) > 0
    return F.coalesce(vector.isNotNull() & sized & finite, F.lit(False))


def integers(column: pa.Array, components: int, scale: int, largest: int) -> np.ndarray:
    """floor(scale * x) of a list column, as rows of 64-bit integers."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, components)
    scaled = np.floor(values * scale)
    if scaled.size and np.abs(scaled).max() > largest:
        raise ValueError(f"a component times {scale} exceeds {largest}: squared distances would not fit a long")
    return scaled.astype(np.int64)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as a list column."""
    offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


@dataclass(frozen=True)
class Rotation:
    """An orthonormal basis by falling variance, about a mean."""

    mean: np.ndarray
    basis: np.ndarray
    leading: int

    def turned(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, norm of the rest, norm of all."""
        turned = (rows - self.mean) @ self.basis
        rest = turned[:, self.leading :]
        return turned[:, : self.leading], np.sqrt((rest * rest).sum(1)), np.sqrt((turned * turned).sum(1))


def _moments(components: int, scale: int, largest: int):
    """Arrow batches (vector) -> (i, j, s): sums of products of components, and of components at j = components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components + 1, components + 1))
        for batch in batches:
            rows = integers(batch.column(0), components, scale, largest).astype(np.float64)
            rows = np.hstack([rows, np.ones((len(rows), 1))])
            total += rows.T @ rows
        if total[-1, -1]:
            i, j = np.triu_indices(components + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "s"]
            )

    return run


def rotation(vectors: DataFrame, components: int, scale: int, largest: int, leading: int) -> Rotation:
    """The principal components of ``vectors`` (vector); none of the results depends on its rounding."""
    sums = vectors.mapInArrow(_moments(components, scale, largest), "i int, j int, s double")
    total = np.zeros((components + 1, components + 1))
    for row in sums.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # one row a pair of components
        total[row.i, row.j] = total[row.j, row.i] = row.s
    n = max(1.0, total[-1, -1])
    mean = total[:-1, -1] / n
    _, basis = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(basis[:, ::-1]), min(leading, components))


def nearest(
    rows: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, turn: Rotation
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of every row, and how many distances were verified."""
    c_lead, c_rest, c_norm = turn.turned(centroids.astype(np.float64))
    lead, rest = lead.astype(np.float64), rest.astype(np.float64)
    own = (lead * lead).sum(1)
    bound = own[:, None] + (c_lead * c_lead).sum(1) - 2 * (lead @ c_lead.T) + (rest[:, None] - c_rest) ** 2
    margin = LEAST_MARGIN + MARGIN * (np.sqrt(own + rest * rest)[:, None] + c_norm)
    bound = np.maximum(np.sqrt(np.maximum(bound, 0)) - margin, 0) ** 2
    best = bound.argmin(1)
    distance = ((rows - centroids[best]) ** 2).sum(1)
    # one in 2^52 more, as the integer becomes a double
    left = bound <= distance[:, None] * (1 + 2.0**-50)
    left[np.arange(len(rows)), best] = False
    row, number = np.nonzero(left)
    for at in range(0, len(row), AT_ONCE):
        r, c = row[at : at + AT_ONCE], number[at : at + AT_ONCE]
        d = ((rows[r] - centroids[c]) ** 2).sum(1)
        # by distance, then number, so that the first of every row counts
        order = np.lexsort((c, d, r))
        first = order[np.unique(r[order], return_index=True)[1]]
        r, c, d = r[first], c[first], d[first]
        closer = (d < distance[r]) | ((d == distance[r]) & (c < best[r]))
        best[r[closer]], distance[r[closer]] = c[closer], d[closer]
    return best, distance, len(rows) + len(row)


def _read(batch: pa.RecordBatch, components: int, leading: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = batch.column("q").flatten().to_numpy().astype(np.int64).reshape(-1, components)
    return rows, batch.column("lead").flatten().to_numpy().reshape(-1, leading), batch.column("rest").to_numpy()


def _sums(centroids: np.ndarray, turn: Rotation):
    """Stored batches -> (cluster, n, s): a row a cluster of the task."""
    components = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            rows, lead, rest = _read(batch, components, turn.leading)
            if len(rows):
                best, _, _ = nearest(rows, lead, rest, centroids, turn)
                n += np.bincount(best, minlength=len(n))
                np.add.at(s, best, rows)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there.astype(np.int32)), pa.array(n[there]), lists(s[there], pa.int64())], ["cluster", "n", "s"]
        )

    return run


def _assigned(centroids: np.ndarray, turn: Rotation):
    """Stored batches -> (id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lead, rest = _read(batch, centroids.shape[1], turn.leading)
            best, distance, _ = nearest(rows, lead, rest, centroids, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(best.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
            )

    return run


def stored(vectors: DataFrame, turn: Rotation, components: int, scale: int, largest: int) -> DataFrame:
    """(id, q, lead, rest) of rows (id, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column("vector"), components, scale, largest)
            lead, rest, _ = turn.turned(rows.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), lists(rows, pa.int32()), lists(lead, pa.float32()), pa.array(rest, pa.float32())],
                ["id", "q", "lead", "rest"],
            )

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, q array<int>, lead array<float>, rest float")


def floored_means(centroids: np.ndarray, sums: DataFrame, by: str) -> np.ndarray:
    """Centroids replaced by the exact floor of sum / n of rows (by, n, s); others stay."""
    width = centroids.shape[1]
    total = sums.groupBy(by).agg(
        F.sum("n").alias("n"), F.array(*(F.sum(F.col("s")[i].cast("decimal(38,0)")) for i in range(width))).alias("s")
    )
    moved = centroids.copy()
    for row in total.collect():  # one row a centroid
        moved[row[by]] = [int(x) // row.n for x in row.s]
    return moved


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    seed: str = "2",
    leading: int = LEADING,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster int, distance bigint, cluster_inertia, inertia) of every usable vector, and the final centroids.

    The first centroids are the ``k`` vectors with the smallest sha256 of ``<seed>:<id>``.
    """
    largest = min(LARGEST, int((2**62 / components) ** 0.5 / 2))
    kept = vectors.where(usable(F.col(vector), components)).select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    turn = rotation(kept.select("vector"), components, scale, largest, leading)
    rows = settled(stored(kept, turn, components, scale, largest))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(drawn.alias("drawn"), "q").orderBy("drawn", "q").limit(k).collect()
    centroids = np.array([r.q for r in first], np.int64).reshape(len(first), components)
    if not first:
        empty = rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return empty.withColumns({c: F.col("distance") for c in ("cluster_inertia", "inertia")}), centroids
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(centroids, turn), "cluster int, n bigint, s array<bigint>")
        centroids = floored_means(centroids, sums, "cluster")
    kind = rows.schema["id"].dataType.simpleString()
    found = settled(rows.mapInArrow(_assigned(centroids, turn), f"id {kind}, cluster int, distance bigint"))
    each = found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # one row a centroid
    own = F.element_at(F.create_map(*(F.lit(x) for r in each for x in (r.cluster, r.s))), F.col("cluster"))
    return found.withColumns(
        {"cluster_inertia": own.cast("bigint"), "inertia": F.lit(sum(r.s for r in each)).cast("bigint")}
    ), centroids


def digest(centroid: np.ndarray) -> str:
    """Lowercase hex sha256 of components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
