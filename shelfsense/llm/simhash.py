"""SimHash fingerprints and exact near-duplicate groups through vantage-point trees.

Fingerprints within ``distance`` bits differ in at most ``distance // 2`` bits of one of their two halves. A
tree a half, fitted on a bounded sample, splits fingerprints at every node by their Hamming distance from a
vantage point: inside its radius or outside. By the triangle inequality a partner of a fingerprint inside
lies less than ``distance // 2`` bits outside, so whatever stands that close to a boundary also goes inside:
the shards on both sides of it are searched, all others pruned. Two partners meet in a leaf of one of the trees,
and there all 64 bits are compared. A leaf that is still large is dealt to parts and compared part by part.

Only distinct fingerprints are searched, and a leaf hands on one link a member, not all pairs; the links are
then closed to components. Null texts are empty, and texts without words have fingerprint zero, linked like any
other. A component's id is its smallest id; null ids never are (a group of null ids alone has none). Repeated rows
get equal results; other columns are not looked at; empty tables give empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.graph import components
from shelfsense.shared import settled

#: Fingerprints that a leaf should hold; from four times as many on it is compared in parts.
LEAF = 1024
#: Sampled fingerprints a leaf, and the most levels of a tree: the sample has 2 ** 20 fingerprints at most.
SAMPLE, LEVELS = 16, 16
SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bit i is set if it is set in more than half of the shingles' XXH64 hashes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    stops = (ends[shingle - 1 :] - 1 if len(words) >= shingle else ends[-1:] - 1).tolist()
    starts = [0, *ends.tolist()][: len(stops)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), "<u8", len(stops))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((fingerprint(t.as_py() or "", shingle) for t in batch.column(2)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bits.view(np.int64))], ["id", "text_hash", "bits"]
            )

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id bigint, text_hash bigint, bits bigint) of every row; the hash tells texts of one id apart."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(whole).alias("text_hash"), whole)
    return rows.mapInArrow(_fingerprints(shingle), "id bigint, text_hash bigint, bits bigint")


def _half(bits: np.ndarray, tree: int) -> np.ndarray:
    return (bits.view(np.uint64) >> np.uint64(32 * tree)).astype(np.uint32)


def fit_tree(halves: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(vantage point, radius) of the inner nodes in heap order; a radius halves a node's sample."""
    points, radii = np.zeros(2**levels - 1, np.uint32), np.full(2**levels - 1, 32, np.int8)
    held = {0: halves}
    for node in range(len(points)):
        own = held.pop(node, halves[:0])
        if not len(own):
            continue
        points[node] = own[len(own) // 2]
        far = np.bitwise_count(own ^ points[node])
        within = np.cumsum(np.bincount(far, minlength=33))
        radii[node] = np.abs(2 * within - len(own)).argmin()
        outside = far > radii[node]
        held[2 * node + 1], held[2 * node + 2] = own[~outside], own[outside]
    return points, radii


def _route(trees: list, levels: int, slack: int):
    """Arrow batches of (bits) -> (tree, leaf, bits): the leaf of each half and those a boundary away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False)
            for tree, (points, radii) in enumerate(trees):
                halves, which, node = _half(bits, tree), np.arange(len(bits)), np.zeros(len(bits), np.int32)
                for _ in range(levels):
                    far = np.bitwise_count(halves[which] ^ points[node]).astype(np.int16) - radii[node]
                    near = (far > 0) & (far <= slack)
                    which = np.concatenate([which, which[near]])
                    node = np.concatenate([2 * node + 1 + (far > 0), 2 * node[near] + 1]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), tree, np.int32)), pa.array(node), pa.array(bits[which])],
                    ["tree", "leaf", "bits"],
                )

    return run


def _linked(distance: int):
    """The fingerprints of a leaf (or of two of its parts) -> a link from each to the least of its group there."""

    def run(table: pa.Table) -> pa.Table:
        bits = np.unique(table["bits"].to_numpy())
        raw, label = bits.view(np.uint64), np.arange(len(bits))
        for at in range(0, len(raw), 256):
            close = np.bitwise_count(raw[at : at + 256, None] ^ raw[None, :]) <= distance
            for i in np.flatnonzero(close.sum(1) > 1):
                groups = np.unique(label[close[i]])
                if len(groups) > 1:
                    label[np.isin(label, groups)] = groups[0]
        moved = label != np.arange(len(bits))
        return pa.table({"a": pa.array(bits[moved]), "b": pa.array(bits[label[moved]])})

    return run


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b) links between distinct fingerprints ``distinct`` (bits) that connect all within ``distance`` bits."""
    distinct = distinct.select("bits")
    n = distinct.count()
    levels = max(0, min(LEVELS, math.ceil(math.log2(max(1, n) / LEAF))))
    sample = distinct.orderBy(F.xxhash64("bits")).limit(SAMPLE * 2**levels).toPandas()["bits"].to_numpy(np.int64)
    trees = [fit_tree(_half(sample, tree), levels) for tree in range(2)]
    routed = distinct.mapInArrow(_route(trees, levels, distance // 2), "tree int, leaf int, bits bigint")
    sizes = routed.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / (4 * LEAF)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    met = (
        routed.join(F.broadcast(sizes), ["tree", "leaf"])  # at most 2 * 2 ** LEVELS small rows
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("tree", "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "bits")
    )
    return met.groupBy("tree", "leaf", "i", "j").applyInArrow(_linked(distance), "a bigint, b bigint")


def groups(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``prints`` (id, bits, ...) with component_id: the smallest id reachable over links."""
    prints = settled(prints)
    distinct = settled(prints.groupBy("bits").agg(F.min("id").alias("id")))
    stars = components(links(distinct, distance))
    rooted = distinct.join(stars.select(F.col("a").alias("bits"), F.col("b").alias("root")), "bits", "left").select(
        "bits", "id", F.coalesce("root", "bits").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return prints.join(rooted.select("bits", "root").join(least, "root").drop("root"), "bits")


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """The rows of ``docs`` of smallest id in each group, one row a group, columns as they are."""
    found = groups(fingerprints(docs, key, text, shingle), distance)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    # a group of null ids alone has no component id, so its fingerprint stands in
    kept = (
        found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("bits")))
        .agg(F.min(order).alias("best"))
        .select(F.coalesce("best.id", F.lit(2**63 - 1)).alias("_id"), F.col("best.text_hash").alias("_hash"))
    )
    keyed = docs.withColumns(
        {
            "_id": F.coalesce(F.col(key).cast("bigint"), F.lit(2**63 - 1)),
            "_hash": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
        }
    )
    return keyed.join(kept, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).drop("_id", "_hash")
