"""Removal of word sequences that stand earlier in the corpus, behind a count-min prefilter.

A window is ``width`` consecutive words of one document. A word goes if a window that covers it has the
same words as a window that starts earlier: in a document of smaller id, or before it in the same one.

* Texts are dealt to buckets of bounded size by their ids. A window is counted under its *anchor*, the
  ``GRAM``-word sequence of smallest hash in it: equal windows have equal anchors, so the count of an anchor
  is never below that of its windows, and there are only about two anchors to ``width - GRAM + 2`` words.
* Every bucket makes a count-min sketch of its anchors. Counts stop at two and most cells are empty, so a
  sketch is the list of its cells that are not zero. Sketches are merged by ranges of cells, each range in a
  task of its own, and every bucket is told which of its cells came to two or more. No sketch is broadcast,
  and nothing saturates as the corpus grows.
* Only windows whose anchor is estimated repeated in all rows of the sketch are grouped exactly, by 96 bits of
  hash. A bucket sends the first of its equal windows, whatever number it has; so one window that holds any
  share of the corpus costs one row a bucket.

Words are ``[^\\x20\\x09-\\x0D]+``. Null texts have no words. A null id comes after all others, by text. Rows
that share an id are ordered by text, and wholly repeated rows are one document, each with its result. Extra
columns pass through unless an output column has their name; empty tables give empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Words of an anchor.
GRAM = 8
#: Rows of the sketch, each of 2 ** 32 cells a shard.
DEPTH = 2
#: Code points of text in a bucket, and in the texts behind one range of cells or windows, on average.
BUCKET_CHARS = 4_000_000
SHARD_CHARS = 32_000_000

_SENT = "shard int, bucket int, w binary, v binary, doc binary, tie binary, at binary, again binary"
_LAST = np.int64(2**63 - 1)


def _mix(a: np.ndarray, b: np.ndarray, factor: int) -> np.ndarray:
    """A 64-bit hash of pairs of 64-bit hashes; the order in a pair matters."""
    z = (a * np.uint64(factor)) ^ (b + (a >> np.uint64(29)))
    z *= np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(32))


def _hash_runs(words: np.ndarray, n: int, factor: int) -> np.ndarray:
    """Hashes of all ``n`` consecutive entries, from hashes of runs of powers of two."""
    size, power, at, result = 1, words, 0, None
    while True:
        if n & size:
            if result is None:
                result = power
            else:
                m = len(words) - at - size + 1
                result = _mix(result[:m], power[at : at + m], factor + 2 * size)
            at += size
        if at == n:
            return result[: len(words) - n + 1]
        power = _mix(power[:-size], power[size:], factor)
        size *= 2


def _slide(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over all ``n`` consecutive entries."""
    size, power = 1, values
    while 2 * size <= n:
        power = pick(power[:-size], power[size:])
        size *= 2
    m = len(values) - n + 1
    return pick(power[:m], power[n - size : n - size + m])


class _Bucket:
    """The distinct documents of a bucket in order, and the hashes of their windows."""

    def __init__(self, table: pa.Table, key: str, text: str, width: int):
        ids = [_LAST if x is None else x for x in table[key].to_pylist()]
        texts = [(x or "").encode() for x in table[text].to_pylist()]
        ties = [xxhash.xxh64_intdigest(t) >> 1 if i == _LAST else 0 for i, t in zip(ids, texts, strict=True)]
        rows: list[tuple[int, int, bytes]] = []
        self.row_of = np.empty(len(ids), np.int32)  # of each row of the table
        for k in sorted(range(len(ids)), key=lambda k: (ids[k], ties[k], texts[k])):
            if not rows or (ids[k], ties[k], texts[k]) != rows[-1]:
                rows.append((ids[k], ties[k], texts[k]))
            self.row_of[k] = len(rows) - 1
        self.texts = [t for _, _, t in rows]
        self.doc = np.array([i for i, _, _ in rows], np.int64)
        self.tie = np.array([t for _, t, _ in rows], np.int64)
        for k in range(1, len(rows)):  # ids that several texts share
            if rows[k][:2] == rows[k - 1][:2]:
                self.tie[k] = self.tie[k - 1] + 1
        self.width = width

    def hash(self) -> None:
        split = pc.ascii_split_whitespace(pa.array(self.texts, pa.binary()).cast(pa.string()))
        flat = split.flatten().dictionary_encode()
        each = (xxhash.xxh64_intdigest(x) for x in flat.dictionary.to_pylist())
        hashes = np.fromiter(each, np.uint64, len(flat.dictionary))
        words = hashes[flat.indices.to_numpy()] if len(flat) else np.empty(0, np.uint64)
        counts = np.diff(split.offsets.to_numpy())
        real = words != np.uint64(xxhash.xxh64_intdigest(""))
        row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[real]
        words = words[real]
        start = np.zeros(len(self.texts) + 1, np.int64)
        np.cumsum(np.bincount(row, minlength=len(self.texts)), out=start[1:])
        n = max(0, len(words) - self.width + 1)
        self.words, self.row, self.start = words, row, start
        self.whole = row[:n] == row[len(row) - n :]  # windows within one document
        if n:
            grams = _hash_runs(words, GRAM, 0x9E3779B97F4A7C15)
            self.anchor = np.where(self.whole, _slide(grams, self.width - GRAM + 1, np.minimum), np.uint64(0))
            # a gram is an anchor if it is the smallest of some window that holds it
            pad = np.zeros(self.width - GRAM, np.uint64)
            over = _slide(np.concatenate([pad, self.anchor, pad]), self.width - GRAM + 1, np.maximum)
            self.anchors = grams[over == grams]
        else:
            self.anchor = self.anchors = np.empty(0, np.uint64)


def _cells(anchors: np.ndarray, shards: int) -> list[np.ndarray]:
    """For each row of the sketch, cells as shard * 2 ** 32 + cell."""
    found = []
    for depth in range(DEPTH):
        h = _mix(anchors, np.full_like(anchors, depth + 1), 0xC2B2AE3D27D4EB4F)
        shard = (h >> np.uint64(40)) % np.uint64(shards) + np.uint64(depth * shards)
        found.append((shard << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))
    return found


def _by_shard(keys: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of ``keys`` by their shard."""
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.diff(shard[order])) + 1
    for part in np.split(order, edges) if len(order) else []:
        yield int(shard[part[0]]), part


def _sketches(key: str, text: str, width: int, shards: int):
    def run(group: tuple, table: pa.Table) -> pa.Table:
        bucket = _Bucket(table, key, text, width)
        bucket.hash()
        out: list[tuple[int, bytes]] = []
        for cells in _cells(bucket.anchors, shards):
            cells.sort()
            again = np.zeros(len(cells), bool)
            again[2:] = cells[2:] == cells[:-2]
            cells = cells[~again]  # two are as good as more
            for shard, part in _by_shard(cells, cells >> np.uint64(32)):
                out.append((shard, cells[part].astype("<u4").tobytes()))
        return pa.table(
            {
                "shard": pa.array([s for s, _ in out], pa.int32()),
                "bucket": pa.array([group[0].as_py()] * len(out), pa.int32()),
                "cells": pa.array([c for _, c in out], pa.binary()),
            }
        )

    return run


def _merge_sketches(group: tuple, table: pa.Table) -> pa.Table:
    """Each bucket's cells of this range whose merged count is two or more."""
    own = [np.frombuffer(x, "<u4") for x in table["cells"].to_pylist()]
    every = np.sort(np.concatenate(own))
    repeated = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for cells in own:
        cells = np.unique(cells)
        at = np.minimum(np.searchsorted(repeated, cells), max(0, len(repeated) - 1))
        out.append((cells[repeated[at] == cells] if len(repeated) else cells[:0]).tobytes())
    return pa.table({"bucket": table["bucket"], "shard": table["shard"], "cells": pa.array(out, pa.binary())})


def _candidates(key: str, text: str, width: int, shards: int):
    """A bucket's windows estimated repeated: the first of equal ones in full, the others as places to remove."""
    schema = pa.schema(
        [("shard", pa.int32()), ("bucket", pa.int32()), *((n, pa.binary()) for n in ("w", "v", "doc", "tie", "at", "again"))]
    )

    def run(group: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not len(table) or not len(told):
            return schema.empty_table()
        bucket = _Bucket(table, key, text, width)
        bucket.hash()
        pairs = zip(told["shard"].to_pylist(), told["cells"].to_pylist(), strict=True)
        repeated = np.sort(
            np.concatenate([np.frombuffer(c, "<u4").astype(np.uint64) | np.uint64(s << 32) for s, c in pairs])
        )
        if not len(repeated) or not len(bucket.anchor):
            return schema.empty_table()
        anchors, back = np.unique(bucket.anchor, return_inverse=True)
        likely = np.ones(len(anchors), bool)
        for cells in _cells(anchors, shards):
            at = np.minimum(np.searchsorted(repeated, cells), len(repeated) - 1)
            likely &= repeated[at] == cells
        at = np.flatnonzero(likely[back] & bucket.whole)
        w = _hash_runs(bucket.words, width, 0x9E3779B97F4A7C15)[at]
        v = (_hash_runs(bucket.words, width, 0xD6E8FEB86659FD93)[at] >> np.uint64(32)).astype("<u4")
        order = np.lexsort((at, v, w))
        w, v, at = w[order], v[order], at[order]
        first = np.ones(len(at), bool)
        first[1:] = (w[1:] != w[:-1]) | (v[1:] != v[:-1])
        row = bucket.row[at]
        place = np.stack([row, (at - bucket.start[row]).astype(np.int32)], 1).astype("<i4")
        out = []
        for shard, part in _by_shard(w, w % np.uint64(shards)):
            one, more = part[first[part]], part[~first[part]]
            values = (w[one], v[one], bucket.doc[row[one]], bucket.tie[row[one]], place[one], place[more])
            out.append((shard, group[0].as_py(), *(x.tobytes() for x in values)))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema) if out else schema.empty_table()

    return run


def _first_windows(group: tuple, table: pa.Table) -> pa.Table:
    """For each bucket, the places of its windows that also start earlier."""

    def joined(name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
        own = [np.frombuffer(x, kind) for x in table[name].to_pylist()]
        return np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])

    (w, source), (v, _), (doc, _), (tie, _) = joined("w", "<u8"), joined("v", "<u4"), joined("doc", "<i8"), joined("tie", "<i8")
    place = joined("at", "<i4")[0].reshape(-1, 2)
    order = np.lexsort((place[:, 1], tie, doc, v, w))
    later = np.zeros(len(order), bool)
    later[1:] = (w[order[1:]] == w[order[:-1]]) & (v[order[1:]] == v[order[:-1]])
    gone = np.zeros(len(order), bool)
    gone[order] = later
    ends = np.searchsorted(source, np.arange(len(table) + 1))
    again = table["again"].to_pylist()
    out = [place[a:b][gone[a:b]].tobytes() + again[i] for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]
    return pa.table({"bucket": table["bucket"], "places": pa.array(out, pa.binary())})


def _kept(key: str, text: str, width: int, others: list[str], schema: pa.Schema):
    def run(group: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        bucket = _Bucket(table, key, text, width)
        places = np.concatenate([np.frombuffer(x, "<i4") for x in told["places"].to_pylist()] or [np.empty(0, "<i4")]).reshape(-1, 2)
        places = places[np.argsort(places[:, 0], kind="stable")]
        ends = np.searchsorted(places[:, 0], np.arange(len(bucket.texts) + 1))
        n_words, n_removed, kept = [], [], []
        for i, whole in enumerate(bucket.texts):
            words = whole.split()
            starts = places[ends[i] : ends[i + 1], 1]
            if len(starts):
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + width, -1)
                stays = np.cumsum(change[:-1]) == 0
                left = [word for word, stay in zip(words, stays.tolist(), strict=True) if stay]
            else:
                left = words
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left))
        back = bucket.row_of
        made = {
            "n_words": pa.array(np.array(n_words, np.int64)[back]),
            "n_removed": pa.array(np.array(n_removed, np.int64)[back]),
            "kept": pa.array([kept[i] for i in back], pa.binary()).cast(pa.string()),
        }
        return pa.table([made[f.name] if f.name in made else table[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 20) -> DataFrame:
    """``docs`` with n_words, n_removed and ``kept``: the words that stay, joined by one space."""
    if width <= GRAM:
        raise ValueError(f"a window has more than {GRAM} words")
    docs = docs.drop("n_words", "n_removed", "kept", "bucket")
    chars = docs.select(F.sum(F.length(text))).first()[0] or 0
    buckets, shards = math.ceil((chars + 1) / BUCKET_CHARS), math.ceil((chars + 1) / SHARD_CHARS)
    bucket = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.col(text))), F.lit(buckets)).cast("int")
    dealt = docs.withColumn("bucket", bucket)
    texts = dealt.groupBy("bucket")
    told = (
        texts.applyInArrow(_sketches(key, text, width, shards), "shard int, bucket int, cells binary")
        .groupBy("shard")
        .applyInArrow(_merge_sketches, "bucket int, shard int, cells binary")
    )
    places = (
        texts.cogroup(told.groupBy("bucket"))
        .applyInArrow(_candidates(key, text, width, shards), _SENT)
        .groupBy("shard")
        .applyInArrow(_first_windows, "bucket int, places binary")
    )
    made = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]
    schema = StructType([*docs.schema.fields, *made])
    run = _kept(key, text, width, docs.columns, to_arrow_schema(schema))
    return texts.cogroup(places.groupBy("bucket")).applyInArrow(run, schema)
