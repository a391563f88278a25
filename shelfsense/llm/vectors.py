"""Near-duplicate vectors by sorted projection passes.

In every pass, vectors are ordered lexicographically by the sign bits of random projections (then by a hash), and each
is compared with its next ``window`` neighbours; close vectors agree
in long prefixes and so stand close. Pairs of cosine at least ``least`` are united across all passes. As many passes as
the number of vectors asks for, were they spread evenly, take all of them. How crowded it is around each vector is then
measured: the bits after which no more than a window's vectors share its prefix, and so the chance of a pass to show
it a partner at the threshold. The geometric mean over the passes counts: a pass that parts a crowd with few bits has
planes right through it, which part close pairs as well, so its high chance is deceptive. Vectors whose chance is too small
go through further passes, as many as bring the chance of a miss down to ``MISSED_CROWDED``; only crowded vectors are in
those. Of components that would fill the windows, which are
compared in full anyway, a varying share is in each of these passes. The window ends at a partition's border, which concerns ``window`` rows of each.

A group of more members than a window holds is found as a component, and every component is then compared with
itself in full, in blocks of bounded size, so that the links counted are all there are between its members.

Equal vectors are one node with a multiplicity; nodes are told apart by a 64-bit hash of their values. Vectors
that are null, zero, or hold null or non-finite components link with nothing, not even their copies. Links are
counted between rows, so wholly repeated rows link with each other. A null id is never the smallest of its component.
Of vectors of unequal length, the shorter counts as filled up with zeros. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.graph import components
from shelfsense.shared import settled

#: Neighbours each vector is compared with in a pass; chance of missing a pair at the threshold; most members a block.
WINDOW, MISSED, BLOCK = 32, 0.02, 4096
#: The same chance in crowded places, where it is estimated from few passes.
MISSED_CROWDED = 0.005
#: Sign bits of a pass.
SIGNS = 63


def _alike(least: float) -> float:
    """The probability that a random plane does not part a pair at ``least``."""
    return 1 - math.acos(least) / math.pi


def passes(n: int, window: int, least: float) -> int:
    """So many that a pair among evenly spread vectors shares a window's prefix in one of them with probability 1 - MISSED."""
    bits = max(1.0, math.log2(max(2, n) / window))
    alike = _alike(least) ** bits
    return max(2, math.ceil(math.log(MISSED) / math.log(1 - alike)))


def _matrix(column) -> np.ndarray:
    """A list column of finite numbers as rows of unit length, in double precision, zeros behind shorter lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    values = np.zeros((len(sizes), sizes.max(initial=0)))
    values[np.arange(values.shape[1]) < sizes[:, None]] = flat
    # the largest component first, lest squares overflow
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _projected(seed: int):
    """Arrow batches (h, vector, first, turns, share) -> (turn, place, h, vector): where each vector stands in its passes.

    These are the passes from ``first`` up to ``turns``, and of them a random ``share``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows, h = _matrix(batch.column(1)), batch.column(0).to_numpy()
            first, turns, share = (batch.column(i).to_numpy() for i in (2, 3, 4))
            for turn in range(int(first.min()), int(turns.max())):
                mixed = (h.view(np.uint64) ^ np.uint64(turn * 0xD1B54A32D192ED03 % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
                drawn = ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(11)) * 2.0**-53
                there = np.flatnonzero((first <= turn) & (turn < turns) & (drawn < share))
                if not len(there):
                    continue
                planes = np.random.default_rng([seed, turn]).normal(size=(rows.shape[1], SIGNS))
                place = np.zeros(len(there), np.int64)
                for bit in (rows[there] @ planes > 0).T:
                    place = place << 1 | bit
                some = pa.array(there)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(there), turn, np.int32)), pa.array(place), batch.column(0).take(some), batch.column(1).take(some)],
                    ["turn", "place", "h", "vector"],
                )

    return run


def _chances(window: int, least: float):
    """Sorted batches (turn, place, h) -> (h, chance) of a vector to meet a partner at ``least`` in that pass."""

    def measured(turn: np.ndarray, place: np.ndarray) -> np.ndarray:
        bits = np.zeros(len(turn))
        if len(turn) > window:
            _, parted = np.frexp((place[window:] ^ place[:-window]).astype(float))
            shared = np.where(turn[window:] == turn[:-window], SIGNS - parted, 0)
            bits[:-window] = shared
            bits[window:] = np.maximum(bits[window:], shared)
        return _alike(least) ** (bits + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, told = None, 0
        for batch in batches:
            now = [column.to_numpy() for column in batch.columns]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            # the last rows wait for those behind them
            sure = max(told, len(held[0]) - window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[2][told:sure]), pa.array(measured(*held[:2])[told:sure])], ["h", "chance"]
            )
            cut = max(0, sure - window)
            held, told = [x[cut:] for x in held], sure - cut
        if held is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[2][told:]), pa.array(measured(*held[:2])[told:])], ["h", "chance"]
            )

    return run


def _neighbours(window: int, least: float):
    """Sorted batches (turn, place, h, vector) -> links (a, b) that connect all pairs found in the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                turn, h, rows = part.column(0).to_numpy(), part.column(2).to_numpy(), _matrix(part.column(3))
                if last is not None:
                    width = max(last[2].shape[1], rows.shape[1])
                    before, rows = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (last[2], rows))
                    turn, h, rows = (np.concatenate(x) for x in zip((*last[:2], before), (turn, h, rows), strict=True))
                last = turn[-window:], h[-window:], rows[-window:]
                label = np.arange(len(h))
                for step in range(1, min(window, len(h) - 1) + 1):
                    cosine = np.einsum("ij,ij->i", rows[:-step], rows[step:])
                    for i in np.flatnonzero((cosine >= least) & (turn[:-step] == turn[step:])):
                        a, b = label[i], label[i + step]
                        if a != b:
                            label[label == max(a, b)] = min(a, b)
                moved = label != np.arange(len(h))
                yield pa.RecordBatch.from_arrays([pa.array(h[moved]), pa.array(h[label[moved]])], ["a", "b"])

    return run


def _counted(least: float):
    """A block of a component (part i, part j, h, copies, vector) -> (h, links) to the copies linked there."""

    def run(table: pa.Table) -> pa.Table:
        first, second = table["i"][0].as_py(), table["j"][0].as_py()
        own = table["own"].to_numpy()
        left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)
        rows, h, copies = _matrix(table["vector"]), table["h"].to_numpy(), table["copies"].to_numpy()
        links = np.zeros(len(h), np.int64)
        for at in range(0, len(left), 512):
            some = left[at : at + 512]
            close = rows[some] @ rows[right].T >= least
            if first == second:
                close[np.arange(len(some)), np.arange(at, at + len(some))] = False
            links[some] += close @ copies[right]
            if first != second:
                links[right] += copies[some] @ close
        return pa.table({"h": pa.array(h), "links": pa.array(links)})

    return run


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, window: int = WINDOW, seed: int = 7
) -> DataFrame:
    """(id, n_links bigint, component_id, kept) of every row."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        F.col(key).alias("id"), F.when(F.coalesce(sound, F.lit(False)), F.xxhash64(v)).alias("h"), v.alias("vector")
    )
    nodes = settled(
        rows.where("h IS NOT NULL")
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.first("vector").alias("vector"))
    )
    kind = nodes.schema["vector"].dataType.simpleString()
    turns = passes(nodes.count(), window, least)

    def ordered(some: DataFrame, *columns: str) -> DataFrame:
        """Rows (h, vector, first, turns, share) as they stand in their passes."""
        stood = some.select("h", "vector", "first", "turns", "share").mapInArrow(
            _projected(seed), f"turn int, place bigint, h bigint, vector {kind}"
        )
        order = ["turn", "place", "h"]
        return stood.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)

    def met(some: DataFrame) -> DataFrame:
        return ordered(some, "turn", "place", "h", "vector").mapInArrow(_neighbours(window, least), "a bigint, b bigint")

    def members(stars: DataFrame) -> DataFrame:
        return stars.select(F.col("a").alias("h"), F.col("b").alias("root")).unionByName(
            stars.select(F.col("b").alias("h"), F.col("b").alias("root")).distinct()
        )

    every = nodes.withColumns({"first": F.lit(0), "turns": F.lit(turns), "share": F.lit(1.0)})
    stars = settled(components(met(every)))
    # how crowded it is, the members of a component aside but for half a window of them
    member = members(stars)
    shares = member.groupBy("root").agg(F.least(F.lit(1.0), F.lit(window / 2) / F.count(F.lit(1))).alias("share"))
    rooted = every.drop("share").join(member.join(shares, "root"), "h", "left")
    shared = rooted.withColumns({"root": F.coalesce("root", "h"), "share": F.coalesce("share", F.lit(1.0))})
    chances = (
        ordered(shared, "turn", "place", "h")
        .mapInArrow(_chances(window, least), "h bigint, chance double")
        .groupBy("h")
        .agg(F.exp(F.avg(F.log("chance"))).alias("chance"))
    )
    worst = chances.join(shared.select("h", "root"), "h").groupBy("root").agg(F.min("chance").alias("chance"))
    needed = F.log(F.lit(MISSED_CROWDED)) / F.log1p(-F.col("chance"))
    crowded = settled(
        shared.drop("first", "turns")
        .join(worst.where(needed > turns), "root")
        .withColumn("first", F.lit(turns))
        .withColumn("turns", (turns * F.pow(F.lit(2.0), F.ceil(F.log2(needed / turns)))).cast("int"))
    )
    if not crowded.isEmpty():
        stars = settled(components(stars.select("a", "b").unionByName(met(crowded))))
    member = members(stars)
    parts = member.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    blocks = (
        nodes.join(member, "h")
        .join(parts, "root")
        .withColumn("own", F.pmod(F.xxhash64("h"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "h", "copies", "vector")
    )
    counted = (
        blocks.groupBy("root", "i", "j")
        .applyInArrow(_counted(least), "h bigint, links bigint")
        .groupBy("h")
        .agg(F.sum("links").alias("links"))
    )
    smallest = member.join(nodes.select("h", "id"), "h").groupBy("root").agg(F.min("id").alias("least_id"))
    linked = member.join(smallest, "root").join(counted, "h").select("h", "links", "least_id")
    known = nodes.select("h", "copies", F.col("id").alias("own_id")).join(linked, "h", "left")
    component = F.when(F.col("h").isNull(), F.col("id")).otherwise(F.coalesce("least_id", "own_id"))
    return (
        rows.select("id", "h")
        .join(known, "h", "left")
        .select(
            "id",
            F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
    )
