"""Best-k partners by inner product, over tiles of rows that Spark shuffles together.

Rows on the left are dealt to *strips*, rows on the right to *chunks*; one tile is one strip
against one chunk. A task holds a strip (a bounded number of rows) and the best k partners seen
so far of each of its rows, and reads the chunk as a stream of Arrow batches. It hands on at most
k rows per left row, so the pairs themselves never leave it, whatever the data looks like. The
lists of a row's several chunks are merged by a group-limited window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.operators.ranking import top_per_key

STRIP_ROWS = 16384
STRIP_ENTRIES = 2_000_000
CHUNK_ROWS = 1_000_000
MAX_PARTITIONS = 50_000
RIGHT_ROWS_AT_ONCE = 512
HEAD_TERMS = 256
HEAD_SHARE = 16
TAIL_PRODUCTS_AT_ONCE = 4_000_000
NO_ID = np.iinfo(np.int64).max


class BestPartners:
    """The best k (score, id) per left row; equal scores go to the smaller id."""

    def __init__(self, left_ids: np.ndarray, k: int, above: float | None, digits: int | None, skip_self: bool):
        self.left_ids = left_ids
        self.k, self.above, self.digits, self.skip_self = k, above, digits, skip_self
        self.scores = np.full((len(left_ids), k), -np.inf)
        self.ids = np.full((len(left_ids), k), NO_ID)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def offer(self, scores: np.ndarray, right_ids: np.ndarray) -> None:
        """``scores[i, j]`` of left row i with ``right_ids[j]``; ids ascend within and between calls."""
        # whoever comes later has a higher id, so it must beat the present k-th, not just equal it;
        # rounded scores differ by a whole unit, and by nearly half of one before rounding
        floor = self.scores[:, -1] + (0.0 if self.digits is None else 0.4 * 10.0**-self.digits)
        if self.above is not None:
            floor = np.maximum(floor, self.above)
        hit = scores > floor[:, None]
        if np.count_nonzero(hit) * 16 > hit.size:
            # most may still get in: look only at this batch's own best
            some = self._rounded(scores)
            some[~hit] = -np.inf
            if self.skip_self:
                some[self.left_ids[:, None] == right_ids[None, :]] = -np.inf
            found, at = best_columns(some, self.k)
            row, n = np.nonzero(~np.isneginf(found))
            score, rid = found[row, n], right_ids[at[row, n]]
        else:
            at = np.flatnonzero(hit)
            row, col = np.divmod(at, len(right_ids))
            score, rid = self._rounded(scores.ravel()[at]), right_ids[col]
            if self.skip_self:
                fine = rid != self.left_ids[row]
                row, score, rid = row[fine], score[fine], rid[fine]
        self.waiting.append((row, score, rid))
        self.n_waiting += len(row)
        # a merge looks at all k of a row again, so it is put off until it has enough to do
        if self.n_waiting * 2 >= self.ids.size:
            self._merge()

    def _rounded(self, scores: np.ndarray) -> np.ndarray:
        # adding zero turns minus zero into zero
        return scores.copy() if self.digits is None else np.round(scores, self.digits) + 0.0

    def _merge(self) -> None:
        """Take the k best of what each row has and what is waiting for it."""
        if not self.n_waiting:
            return
        row, score, rid = (np.concatenate(parts) for parts in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        by_row = np.argsort(row, kind="stable")
        row, score, rid = row[by_row], score[by_row], rid[by_row]
        new = np.concatenate([[True], row[1:] != row[:-1]])
        rows = row[new]
        owner = np.concatenate([np.repeat(np.arange(len(rows)), self.k), np.cumsum(new) - 1])
        scores = np.concatenate([self.scores[rows].ravel(), score])
        ids = np.concatenate([self.ids[rows].ravel(), rid])
        order = np.lexsort((ids, -scores, owner))
        first = np.searchsorted(owner[order], np.arange(len(rows)))
        kept = order[first[:, None] + np.arange(self.k)]
        self.scores[rows] = scores[kept]
        self.ids[rows] = ids[kept]

    def result(self) -> pa.RecordBatch:
        self._merge()
        row, col = np.nonzero(self.ids != NO_ID)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.left_ids[row]),
                pa.array(self.ids[row, col]),
                pa.array(self.scores[row, col]),
            ],
            names=["id", "rid", "r"],
        )


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and positions of the k largest per row, the first of equal ones first."""
    k = min(k, scores.shape[1])
    if k > 16:
        at = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(scores, at, axis=1), at
    rest = scores.copy()
    rows = np.arange(len(rest))
    at = np.empty((len(rest), k), dtype=np.int64)
    found = np.empty((len(rest), k))
    for n in range(k):
        at[:, n] = rest.argmax(axis=1)
        found[:, n] = rest[rows, at[:, n]]
        rest[rows, at[:, n]] = -np.inf
    return found, at


class DenseStrip:
    """Inner products of equally long number arrays."""

    def __init__(self, left: pa.Table):
        self.matrix = self._matrix(left.column("vec").combine_chunks())

    @staticmethod
    def _matrix(vectors: pa.Array) -> np.ndarray:
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)

    def products(self, right: pa.RecordBatch) -> np.ndarray:
        return self.matrix @ self._matrix(right.column("vec")).T


class SparseStrip:
    """Inner products of term/weight lists.

    Terms found in a good share of the strip's rows go through a dense product, the rest through an
    index from term to strip rows, so neither a huge vocabulary nor a term in every row is a problem.
    """

    def __init__(self, left: pa.Table):
        columns = [left.column(c).combine_chunks() for c in ("terms", "weights")]
        terms, rows, weights = self._entries(*columns)
        self.n_rows = left.num_rows
        coded = terms.dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        code = coded.indices.to_numpy(zero_copy_only=False)
        use = np.bincount(code, minlength=len(coded.dictionary))
        by_use = np.argsort(-use, kind="stable")
        # renumber the terms by falling frequency: the head is then simply code < n_head
        position = np.empty(len(by_use), dtype=np.int64)
        position[by_use] = np.arange(len(by_use))
        self.vocabulary = coded.dictionary.take(pa.array(by_use))
        code = position[code]
        self.n_head = min(HEAD_TERMS, np.count_nonzero(use * HEAD_SHARE >= self.n_rows))
        head = code < self.n_head
        self.head = np.zeros((self.n_rows, self.n_head))
        self.head[rows[head], code[head]] = weights[head]
        order = np.argsort(code[~head], kind="stable")
        self.tail_rows = rows[~head][order]
        self.tail_weights = weights[~head][order]
        uses = np.bincount(code[~head] - self.n_head, minlength=len(by_use) - self.n_head)
        self.tail_start = np.concatenate([[0], np.cumsum(uses)])

    @staticmethod
    def _entries(terms: pa.Array, weights: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        return terms.flatten(), rows, weights.flatten().to_numpy(zero_copy_only=False)

    def products(self, right: pa.RecordBatch) -> np.ndarray:
        terms, rows, weights = self._entries(right.column("terms"), right.column("weights"))
        code = pc.fill_null(pc.index_in(terms, value_set=self.vocabulary), -1)
        code = code.to_numpy(zero_copy_only=False).astype(np.int64)
        head = (code >= 0) & (code < self.n_head)
        dense = np.zeros((right.num_rows, self.n_head))
        dense[rows[head], code[head]] = weights[head]
        out = self.head @ dense.T
        tail = np.flatnonzero(code >= self.n_head)
        at = code[tail] - self.n_head
        uses = self.tail_start[at + 1] - self.tail_start[at]
        done = np.concatenate([[0], np.cumsum(uses)])
        cells = out.ravel()
        start = 0
        while start < len(tail):
            stop = max(start + 1, int(np.searchsorted(done, done[start] + TAIL_PRODUCTS_AT_ONCE, "right")) - 1)
            entry, offset = spans(self.tail_start[at[start:stop]], uses[start:stop])
            mine = tail[start:stop][entry]
            cell = self.tail_rows[offset] * right.num_rows + rows[mine]
            np.add.at(cells, cell, self.tail_weights[offset] * weights[mine])
            start = stop
        return out


def spans(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the positions starts[i] .. starts[i]+lengths[i]-1, as (i, position) columns."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return owner, np.arange(len(owner)) - first[owner] + starts[owner]


def runs(keys: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Bounds of the stretches over which all ``keys`` stay equal."""
    n = len(keys[0])
    if not n:
        return
    change = np.zeros(n - 1, dtype=bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
    yield from zip(cuts[:-1], cuts[1:])


def best_partners(
    strip_type: type, k: int, above: float | None, digits: int | None, skip_self: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task body: rows arrive sorted by (tile, side, id), the left side of a tile first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, left, strip, best = None, [], None, None
        for batch in batches:
            tiles = batch.column("tile").to_numpy()
            sides = batch.column("side").to_numpy()
            for lo, hi in runs([tiles, sides]):
                part = batch.slice(lo, hi - lo)
                if tiles[lo] != tile:
                    if best is not None:
                        yield best.result()
                    tile, left, strip, best = tiles[lo], [], None, None
                if sides[lo] == 0:
                    left.append(part)
                    continue
                if not left:
                    continue
                if strip is None:
                    rows = pa.Table.from_batches(left)
                    strip = strip_type(rows)
                    best = BestPartners(rows.column("id").to_numpy(), k, above, digits, skip_self)
                for start in range(0, part.num_rows, RIGHT_ROWS_AT_ONCE):
                    some = part.slice(start, RIGHT_ROWS_AT_ONCE)
                    best.offer(strip.products(some), some.column("id").to_numpy())
        if best is not None:
            yield best.result()

    return run


def strip_count(rows: int, parallelism: int, strip_rows: int = STRIP_ROWS) -> int:
    """Enough strips to keep every core busy, but none larger than the bound or needlessly small."""
    wanted = max(256, math.ceil(rows / max(1, parallelism)))
    return max(1, math.ceil(rows / min(strip_rows, wanted)))


def top_by_product(
    left: DataFrame,
    right: DataFrame,
    k: int,
    payload: list[str],
    strip_type: type,
    n_left: int,
    n_right: int,
    above: float | None = None,
    digits: int | None = 6,
    skip_self: bool = True,
    strip_rows: int = STRIP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(id, rid, r, rank): for every ``left.id`` the best ``k`` ``right.id`` by inner product.

    Both frames hold ``id`` (bigint) and the payload columns. ``above`` is compared with the full
    score; ranking is on the score rounded to ``digits``, so that equal scores summed in another
    order tie, and ties go to the smaller id.
    """
    spark = left.sparkSession
    strip_rows = max(1, min(strip_rows, STRIP_ENTRIES // k))  # longer lists, fewer rows at a time
    strips = strip_count(n_left, spark.sparkContext.defaultParallelism, strip_rows)
    chunks = max(1, math.ceil(n_right / chunk_rows))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def side(df: DataFrame, number: int, strip: Column, chunk: Column) -> DataFrame:
        return (
            df.select(F.col("id").cast("bigint").alias("id"), *payload, strip.alias("_strip"))
            .select("*", chunk.alias("_chunk"))
            .select(
                (F.col("_strip") * chunks + F.col("_chunk")).alias("tile"),
                F.lit(number).alias("side"),
                "id",
                *payload,
            )
        )

    tiles = side(left, 0, dealt(strips), every(chunks)).unionByName(
        side(right, 1, every(strips), dealt(chunks))
    )
    # if tiles are too many, a strip's chunks go together: its lists are merged before the last shuffle
    together = math.ceil(strips * chunks / MAX_PARTITIONS)
    best = (
        tiles.withColumn("_part", F.floor(F.col("tile") / together).cast("int"))
        .repartitionById(math.ceil(strips * chunks / together), "_part")
        .drop("_part")
        .sortWithinPartitions("tile", "side", "id")
        .mapInArrow(
            best_partners(strip_type, k, above, digits, skip_self), "id bigint, rid bigint, r double"
        )
    )
    return top_per_key(best, "id", k)
