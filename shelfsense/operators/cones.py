"""Best-k partners by cosine above a threshold, where strips of rows and rows that lie too far off never meet.

Strips hold rows nearest to one centre. By the triangle inequality of angles, a row whose angle to the centre exceeds
the widest angle of the strip by more than that of the threshold has no partner there, so it is not sent there. Centres
are a bounded sample: any choice gives the same lists, a good one skips more. Where the rows have no clusters, nothing
is skipped and every strip is read by all rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.operators.ranking import top_per_key
from shelfsense.operators.strips import (
    CHUNK_ROWS,
    MAX_PARTITIONS,
    STRIP_ENTRIES,
    STRIP_ROWS,
    DenseStrip,
    best_partners,
    spans,
    strip_count,
)
from shelfsense.shared import settled

#: Centres at most; a sample of four times as many vectors is all that the driver holds. Cells beyond a strip are cut by hash.
MOST_CENTRES = 1024
#: Radians by which a bound must clear the threshold, more than rounding can move an angle.
SLACK = 1e-6


def centres_of(rows: DataFrame, n: int, wanted: int) -> np.ndarray:
    """At most ``wanted`` different unit vectors: of four times as many, picked by the hash of their id, one after
    another the farthest from those taken, so that copies take one place and no group of the sample goes without."""
    hashed = F.xxhash64("id")
    picked = rows.where(F.pmod(hashed, F.lit(max(1, n))) < 8 * wanted).orderBy(hashed).limit(4 * wanted)
    sample = np.unique(np.array([r.vec for r in picked.select("vec").collect()], dtype=float), axis=0)
    taken: list[int] = []
    closest = np.full(len(sample), -np.inf)
    while len(taken) < min(wanted, len(sample)):
        taken.append(int(closest.argmin()))
        closest = np.maximum(closest, sample @ sample[taken[-1]])
        closest[taken[-1]] = np.inf
    return sample[taken]


def _angles(batch: pa.RecordBatch, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(DenseStrip._matrix(batch.column("vec")) @ centres.T, -1.0, 1.0))


def _nearest(centres: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angles = _angles(batch, centres)
                cell = angles.argmin(axis=1)
                columns = [pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "angle"])

    return run


def _routed(
    centres: np.ndarray, widest: np.ndarray, parts: np.ndarray, reach: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every row's own strip and the strips where it may have a partner."""
    first = np.cumsum(parts) - parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            angles = _angles(batch, centres)
            cell = angles.argmin(axis=1)
            own = first[cell] + batch.column("hash").to_numpy() % np.maximum(parts[cell], 1)
            row, near = np.nonzero(angles <= widest + reach)
            owner, strips = spans(first[near], parts[near])
            ends = np.cumsum(np.bincount(row[owner], minlength=batch.num_rows))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("vec"),
                    pa.array(own.astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(strips.astype(np.int32))),
                ],
                names=["id", "vec", "own", "near"],
            )

    return run


def routes(rows: DataFrame, n: int, above: float, strip_rows: int = STRIP_ROWS) -> tuple[DataFrame, int]:
    """((id, vec, own, near), number of strips) of unit vectors (id, vec)."""
    wanted = strip_count(n, rows.sparkSession.sparkContext.defaultParallelism, strip_rows)
    centres = centres_of(rows, n, min(wanted, MOST_CENTRES))
    if not len(centres):
        return rows.select("id", "vec", F.lit(0).alias("own"), F.array(F.lit(0)).alias("near")), 1
    cells = rows.mapInArrow(_nearest(centres), "cell int, angle double").groupBy("cell").agg(
        F.max("angle").alias("widest"), F.count(F.lit(1)).alias("rows")
    )
    widest, parts = np.full(len(centres), -np.inf), np.zeros(len(centres), dtype=np.int64)
    for cell in cells.collect():  # a row a centre
        widest[cell.cell], parts[cell.cell] = cell.widest, math.ceil(cell.rows / strip_rows)
    reach = math.acos(min(1.0, max(-1.0, above))) + SLACK
    routed = rows.select("id", "vec", F.xxhash64("id").alias("hash")).mapInArrow(
        _routed(centres, widest, parts, reach), "id bigint, vec array<double>, own int, near array<int>"
    )
    return routed, int(parts.sum())


def read_share(routed: DataFrame, strips: int) -> float:
    """Of all pairs of a strip and a row, the share that meets."""
    return routed.agg(F.avg(F.size("near"))).first()[0] / strips


def top_by_cosine(
    rows: DataFrame, k: int, n: int, above: float, strip_rows: int = STRIP_ROWS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(id, rid, r, rank): for each of the ``n`` unit vectors (id, vec) the best ``k`` others of cosine above ``above``.

    As ``strips.top_by_product`` would give them, equal rounded scores by smaller id.
    """
    strip_rows = max(1, min(strip_rows, STRIP_ENTRIES // k))
    routed, strips = routes(rows, n, above, strip_rows)
    routed = settled(routed)
    chunks = max(1, math.ceil(n / chunk_rows))
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")

    def side(number: int, strip, part) -> DataFrame:
        spread = routed.select("id", "vec", strip.alias("_strip")).withColumn("_chunk", part)
        tile = (F.col("_strip") * chunks + F.col("_chunk")).alias("tile")
        return spread.select(tile, F.lit(number).alias("side"), "id", "vec")

    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    tiles = side(0, F.col("own"), every_chunk).unionByName(side(1, F.explode("near"), chunk))
    together = math.ceil(strips * chunks / MAX_PARTITIONS)
    best = (
        tiles.withColumn("_part", F.floor(F.col("tile") / together).cast("int"))
        .repartitionById(math.ceil(strips * chunks / together), "_part")
        .drop("_part")
        .sortWithinPartitions("tile", "side", "id")
        .mapInArrow(best_partners(DenseStrip, k, above, 6, True), "id bigint, rid bigint, r double")
    )
    return top_per_key(best, "id", k)
