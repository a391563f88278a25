"""Vector codes from integer codebooks, searched in the Walsh-Hadamard domain.

Vectors become integers and are cut into equal consecutive parts, one codebook a part position. Parts and entries are
padded with zeros to a power of two and transformed by the Hadamard matrix, rows in order of sequency (sign changes).
The transform keeps squared distances but for the factor of its width, so squared differences of transformed
coordinates, added up in that order, approach width times the distance from below: an entry whose partial sum exceeds
the full sum of a known entry cannot be nearest and is dropped. After the first ``STEP`` coordinates the entry with the
smallest partial sum is summed in full; every further ``STEP`` coordinates are added for the entries still in. What is
left at the end is compared in full, ties going to the lower index. Nothing is reckoned in floating point, and only the
transformed vectors are stored: a sum of transformed parts, transformed once more and divided by the width, is the sum
of the parts.

A round is one pass over the stored vectors that hands on a row a task, part position and entry; codebooks (parts times
entries times components) are all that comes to the driver and goes out again.

Vectors that are null, empty, or hold null or non-finite components are left out; so are those of another length
than most have (of equally frequent lengths the largest counts), as parts of unlike widths share no codebook. A length
that the number of parts does not divide is filled up with zeros. Components beyond what squared distances in a long
allow stop the job with a message. Rows of equal ids are told apart by their components when codebooks are started,
null ids come last. Fewer vectors than entries give as many entries. An empty table gives an empty result. Other
columns are not read, so their names may clash with those used here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.centroids import integers, lists, usable
from shelfsense.shared import settled

#: Transformed coordinates added between two eliminations; parts searched at once; share of pairs left below which
#: they are picked one by one.
STEP, AT_ONCE, MOSTLY = 4, 256, 0.2


def walsh(width: int) -> np.ndarray:
    """The Hadamard matrix of a power of two, rows by falling smoothness: sign changes 0, 1, 2, ..."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < width:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix) != 0).sum(1))]


def padded(length: int, parts: int) -> tuple[int, int]:
    """Components of a part, and the power of two it is padded to."""
    width = -(-length // parts)
    return width, 1 << (width - 1).bit_length()


def transformed(rows: np.ndarray, parts: int) -> np.ndarray:
    """Integer rows as (row, part, coordinate in order of sequency)."""
    width, wide = padded(rows.shape[1], parts)
    whole = np.zeros((len(rows), parts * width), np.int64)
    whole[:, : rows.shape[1]] = rows
    return whole.reshape(len(rows), parts, width) @ walsh(wide)[:, :width].T


def nearest(points: np.ndarray, entries: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """Of transformed points: index of the nearest entry, width times the squared distance, coordinates compared.

    While most pairs of a block are still in, all are added up column by column, which is cheaper than picking them.
    """
    index, total, seen = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64), 0
    width = points.shape[1]
    for start in range(0, len(points), AT_ONCE):
        some = points[start : start + AT_ONCE]
        here = slice(start, start + len(some))
        partial, known = np.zeros((len(some), len(entries)), np.int64), None
        for at in range(0, width, step):
            for t in range(at, min(at + step, width)):
                difference = some[:, t, None] - entries[None, :, t]
                difference *= difference
                partial += difference
            seen += partial.size * min(step, width - at)
            if known is None:
                known = ((some - entries[partial.argmin(1)]) ** 2).sum(1)
            left = partial <= known[:, None]
            if np.count_nonzero(left) < MOSTLY * left.size:
                break
        if at + step >= width:
            # the first of equal sums has the lowest index
            index[here] = partial.argmin(1)
            total[here] = partial[np.arange(len(some)), index[here]]
            continue
        row, entry = np.nonzero(left)
        sums = partial[row, entry]
        for begin in range(at + step, width, step):
            difference = some[row, begin : begin + step] - entries[entry, begin : begin + step]
            sums = sums + (difference * difference).sum(1)
            seen += difference.size
            still = sums <= known[row]
            row, entry, sums = row[still], entry[still], sums[still]
        # rows ascend, and within a row the entries; the known entry of every row is still in
        order = np.lexsort((entry, sums, row))
        first = order[np.unique(row[order], return_index=True)[1]]
        index[here], total[here] = entry[first], sums[first]
    return index, total, seen


def _stored(vectors: DataFrame, length: int, parts: int, scale: int) -> DataFrame:
    """(id, label, w): the transformed parts of a vector, one after another."""
    wide = padded(length, parts)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column("vector"), length, scale, 2**30 // wide)
            w = transformed(rows, parts).reshape(len(rows), parts * wide)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), lists(w, pa.int32())], ["id", "label", "w"]
            )

    id_kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in ("id", "label"))
    return vectors.mapInArrow(run, f"id {id_kind}, label {label_kind}, w array<int>")


def _points(column: pa.Array, parts: int, wide: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, parts, wide)


def _sums(books: np.ndarray):
    """Stored batches -> (part, entry, n, s): sums of transformed parts, a row an entry of the task."""
    parts, entries, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            points = _points(batch.column(0), parts, wide)
            for p in range(parts):
                index, _, _ = nearest(points[:, p], books[p])
                n[p] += np.bincount(index, minlength=entries)
                np.add.at(s[p], index, points[:, p])
        part, entry = np.nonzero(n)
        columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry])]
        yield pa.RecordBatch.from_arrays([*columns, lists(s[part, entry], pa.int64())], ["part", "entry", "n", "s"])

    return run


def _coded(books: np.ndarray):
    """Stored batches -> (id, label, entries, error)."""
    parts, _, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch.column("w"), parts, wide)
            found = [nearest(points[:, p], books[p])[:2] for p in range(parts)]
            index = np.stack([i for i, _ in found], 1)
            error = sum(total // wide for _, total in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), lists(index, pa.int32()), pa.array(error)],
                ["id", "label", "entries", "error"],
            )

    return run


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, entries array<int>, error bigint, label_error bigint) of every usable vector, and the codebooks.

    The codebooks, as (part, entry, component), start from the ``entries`` smallest ids. ``label_error`` adds up the
    errors of equal labels, nulls together.
    """
    usable_rows = vectors.where(usable(F.col(vector), None)).select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    common = usable_rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    length = common["size"] if common else parts
    width, wide = padded(length, parts)
    kept = settled(_stored(usable_rows.where(F.size("vector") == length), length, parts, scale))
    first = kept.select("id", "w").orderBy(F.col("id").asc_nulls_last(), "w").limit(entries).collect()
    back = walsh(wide)[:, :width]
    # (part, entry, coordinate), transformed
    books = np.array([r.w for r in first], np.int64).reshape(len(first), parts, wide).transpose(1, 0, 2)
    id_kind, label_kind = (kept.schema[c].dataType.simpleString() for c in ("id", "label"))
    if not first:
        empty = kept.select("id", "label", F.col("w").alias("entries"), F.lit(0).cast("bigint").alias("error"))
        return empty.withColumn("label_error", F.col("error")), books @ back // wide
    for _ in range(rounds):
        found = kept.select("w").mapInArrow(_sums(books), "part int, entry int, n bigint, s array<bigint>")
        total = found.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *(F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(wide))
        )
        books = books.copy()
        for row in total.collect():  # one row an entry of a codebook
            sums = np.array([int(row[f"s{i}"]) for i in range(wide)], object)
            plain = [int(x) // wide // row.n for x in sums @ back]
            books[row.part, row.entry] = walsh(wide)[:, :width] @ np.array(plain, np.int64)
    coded = settled(
        kept.mapInArrow(_coded(books), f"id {id_kind}, label {label_kind}, entries array<int>, error bigint")
    )
    # a label may hold any share of the rows: sums are reduced before the shuffle, and the join back may be split
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return joined, books @ back // wide


def as_hex(index: Column) -> Column:
    """Indexes below 256 as two lowercase hex digits each, in order."""
    return F.array_join(F.transform(index, lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")


def digest(books: np.ndarray) -> str:
    """Lowercase hex sha256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
