"""Byte-level BPE encoding and decoding.

Texts of at most ``chunk`` code points are encoded where they are read. Longer ones are cut into
overlapping chunks, which are pre-tokenised in parallel. Two neighbouring chunks resynchronise at the
first pre-token boundary that both have found in their overlap; a match depends on nothing before its
start, so from there on both agree. The pieces between these seams are encoded on their own and their
ids joined in order, each with the few characters behind it in view. Where an overlap holds no common boundary (one pre-token longer than the overlap),
the rest of that text is encoded in one piece, which is what a sequential reader would do.

Token ids are kept packed: little-endian unsigned 32-bit integers in one binary value. Null texts count
as empty and have no ids; repeated rows give repeated results; other columns are not looked at.

Besides the Arrow batch it was handed, a Python worker holds the results of a slice of that batch
(``SLICE``) and, while an encoding task lasts, its memo of pre-tokens (``MEMO``, ``LONGEST``).
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, StructField, StructType

#: Code points that a match's end must lie before the end of a chunk to be sure of it: the next
#: characters, as far as any alternative of the pattern looks, are then visible.
LOOKAHEAD = 4
#: Distinct pre-tokens an encoding task remembers, once or twice.
MEMO = 250_000
#: Code points of the longest pre-token it remembers; longer ones hardly recur and are encoded anew.
LONGEST = 64
#: Bytes of texts or ids whose results are built before they leave the worker; one row may have more.
SLICE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id from a rank file: one base64 token and its id per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always the adjacent pair of lowest rank is joined, the leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    none, rank_of = len(ranks) + 1, ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [rank_of(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (lowest := min(pairs)) != none:
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank_of(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = rank_of(parts[i - 1] + parts[i], none)
    return [ranks[part] for part in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, for pre-tokens of any length."""
    end = list(range(1, len(piece) + 1))  # of the part that starts here
    before = list(range(-1, len(piece) - 1))
    dead = bytearray(len(piece))
    heap = [(r, i, i + 2) for i in range(len(piece) - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, left, stop = heapq.heappop(heap)
        right = end[left]
        if dead[left] or right >= len(piece) or end[right] != stop:
            continue  # one of the two parts has grown meanwhile
        dead[right] = 1
        end[left] = stop
        if stop < len(piece):
            before[stop] = left
            if (r := ranks.get(piece[left : end[stop]])) is not None:
                heapq.heappush(heap, (r, left, end[stop]))
        if (previous := before[left]) >= 0 and (r := ranks.get(piece[previous:stop])) is not None:
            heapq.heappush(heap, (r, previous, stop))
    ids, at = [], 0
    while at < len(piece):
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class _Memo(dict):
    """Pre-token -> packed ids. When full it starts anew, but what it held stays at hand for one more time."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            packed = struct.pack(f"<{len(ids := merge(piece.encode(), self.ranks))}I", *ids)
        if len(piece) > LONGEST:
            return packed
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        self[piece] = packed
        return packed


def _share(spark, path: str):
    return spark.sparkContext.broadcast(read_ranks(path))


def _slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows in order, cut so that no more than the last row of a slice leads beyond SLICE bytes of column ``at``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE, prepend=-1)).tolist()
        for begin, end in pairwise([*begins, batch.num_rows]):
            yield batch.slice(begin, end - begin)


def _encoder(shared, pattern: str, names: list[str], sized: bool = False):
    """Arrow batches (names..., text) -> (names..., n_tokens, ids).

    ``sized``: a further column says how many code points of the text count; the others are only in view.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # not kept from task to task: the pool's workers encode and decode by turns, and each would hold a full one
        look, compiled = _Memo(shared.value).__getitem__, regex.compile(pattern)
        for batch in _slices(batches, len(names)):
            texts = batch.column(len(names))
            if sized:
                packed = [
                    b"".join(look(m.group()) for m in compiled.finditer(t.as_py()) if m.end() <= size.as_py())
                    for t, size in zip(texts, batch.column(len(names) + 1), strict=True)
                ]
            else:
                packed = [b"".join(map(look, compiled.findall(t.as_py()))) for t in texts]
            columns = [batch.column(i) for i in range(len(names))]
            n_tokens = pa.array([len(x) // 4 for x in packed], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, n_tokens, pa.array(packed, pa.binary())], [*names, "n_tokens", "ids"]
            )

    return run


def _cutter(chunk: int, overlap: int):
    """Arrow batches (sha, text) -> overlapping chunks (sha, chunk, start, last, body)."""
    names = ["sha", "chunk", "start", "last", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sha, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk - overlap)
                for at in range(0, len(starts), 64):
                    some = starts[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([sha.as_py()] * len(some), pa.string()),
                            pa.array(range(at, at + len(some)), pa.int32()),
                            pa.array(some, pa.int32()),
                            pa.array([s == starts[-1] for s in some], pa.bool_()),
                            pa.array([text[s : s + chunk] for s in some], pa.string()),
                        ],
                        names,
                    )

    return run


def _zones(pattern: str, overlap: int):
    """Arrow batches of chunks -> (sha, chunk, head, tail): sure boundaries in their two overlaps."""
    schema = pa.schema([("sha", pa.string()), ("chunk", pa.int32()), ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = regex.compile(pattern).finditer
        for batch in _slices(batches, 4):
            heads, tails = [], []
            for start, body in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
                sure = len(body) - LOOKAHEAD
                ends = [0, *(end for m in scan(body) if (end := m.end()) <= sure)]
                heads.append([start + e for e in ends if e < overlap])
                tails.append([start + e for e in ends if e >= len(body) - overlap])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, schema.types[2]), pa.array(tails, schema.types[3])], schema=schema)

    return run


def _stitched(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(sha, piece, text, size): every distinct long text as pieces between pre-token boundaries.

    A piece's text goes on a little behind its ``size`` code points, so that matches at its end see enough.
    """
    cut = (
        long.select("sha", "text")
        .mapInArrow(_cutter(chunk, overlap), "sha string, chunk int, start int, last boolean, body string")
        .groupBy("sha", "chunk")  # copies of a text are cut alike and encoded once
        .agg(F.first("start").alias("start"), F.first("last").alias("last"), F.first("body").alias("body"))
    )
    zones = cut.mapInArrow(_zones(pattern, overlap), "sha string, chunk int, head array<int>, tail array<int>")
    # the head of a chunk meets the tail of the one before it
    halves = F.array(
        F.struct("chunk", "head", F.lit(None).cast("array<int>").alias("tail")),
        F.struct((F.col("chunk") + 1).alias("chunk"), F.lit(None).cast("array<int>").alias("head"), "tail"),
    )
    seams = (
        zones.select("sha", F.inline(halves))
        .groupBy("sha", "chunk")
        .agg(F.max("head").alias("head"), F.max("tail").alias("tail"))
        .where("head IS NOT NULL")
        .select("sha", "chunk", F.array_min(F.array_intersect("head", "tail")).alias("seam"))
    )
    # a chunk after a seam that failed has not been proved right, so nothing behind it counts
    by_text = Window.partitionBy("sha")
    failed = F.min(F.when((F.col("chunk") > 0) & F.col("seam").isNull(), F.col("chunk") - 1)).over(by_text)
    known = seams.select(
        "sha",
        "chunk",
        F.coalesce("seam", F.lit(0)).alias("begin"),
        F.lead("seam").over(by_text.orderBy("chunk")).alias("stop"),
        failed.alias("sequential"),
    )
    chunks = cut.join(known, ["sha", "chunk"])
    length = F.coalesce("stop", F.col("start") + F.length("body")) - F.col("begin")
    sound = chunks.where("sequential IS NULL OR chunk < sequential").select(
        "sha",
        F.col("chunk").alias("piece"),
        F.substring("body", F.col("begin") - F.col("start") + 1, length + LOOKAHEAD).alias("text"),
        length.alias("size"),
    )
    skip = F.when(F.col("chunk") == F.col("sequential"), F.col("begin") - F.col("start")).otherwise(0)
    keep = F.when(F.col("last"), F.length("body")).otherwise(chunk - overlap) - skip
    rest = (
        chunks.where("chunk >= sequential")
        .select("sha", "sequential", "chunk", F.substring("body", skip + 1, keep).alias("part"))
        .groupBy("sha", F.col("sequential").alias("piece"))
        .agg(F.expr("listagg(part) WITHIN GROUP (ORDER BY chunk)").alias("text"))
        .withColumn("size", F.length("text"))
    )
    return sound.unionByName(rest)


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = 65_536,
    overlap: int = 1_024,
) -> DataFrame:
    """(key, n_tokens long, ids binary) of every row of ``docs``; ids packed, see the module."""
    if not 0 < 2 * overlap <= chunk:
        raise ValueError("an overlap is at most half a chunk")
    shared = _share(docs.sparkSession, vocabulary)
    key_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = rows.where(F.length("text") <= chunk).mapInArrow(
        _encoder(shared, pattern, ["_key"]), f"_key {key_type}, n_tokens bigint, ids binary"
    )
    long = rows.where(F.length("text") > chunk).withColumn("sha", F.sha2(F.col("text"), 256))
    encoded = (
        _stitched(long, pattern, chunk, overlap)
        .select("sha", "piece", "text", "size")
        .mapInArrow(
            _encoder(shared, pattern, ["sha", "piece"], sized=True), "sha string, piece int, n_tokens bigint, ids binary"
        )
        .groupBy("sha")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.expr("listagg(ids) WITHIN GROUP (ORDER BY piece)").alias("ids"),
        )
    )
    joined = long.select("_key", "sha").join(encoded, "sha").select("_key", "n_tokens", "ids")
    return short.unionByName(joined).withColumnRenamed("_key", key)


def _decoder(shared, at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in shared.value.items()}.__getitem__
        for batch in _slices(batches, at):
            found = [
                None if x is None else b"".join(map(tokens, np.frombuffer(x, "<u4").tolist()))
                for x in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], schema=schema)

    return run


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes its packed ids stand for, as a further binary column ``name``."""
    shared = _share(encoded.sparkSession, vocabulary)
    to = StructType([*encoded.schema.fields, StructField(name, BinaryType())])
    return encoded.mapInArrow(_decoder(shared, encoded.columns.index(ids), to_arrow_schema(to)), to)
