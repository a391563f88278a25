"""Item-to-item similarity by co-rating: both / sqrt(raters of one * raters of the other).

A self-join on the user would emit every pair of a basket (one user's items) as a row. Here a basket is one row, and a
task counts the pairs of many baskets before it hands any on: pairs (smaller item, larger item) with a partial count.
A plain ``groupBy`` adds the partial counts up, and only the sums are mirrored to both directions. Popular pairs,
which make up most of the work, so leave a task once a step and not once a user.

The basket of a heavy user is cut into parts of about ``PART_ITEMS`` items, and its row becomes a row a pair of parts,
which any task may take: neither the items nor the pairs of one user meet in one task.

Where only the best k of an item are asked for and nearly all pairs are different, so that partial counts save nothing,
items are dealt to blocks instead. A *tile*, which one task counts, is a block with all baskets that hold items of it, so
that counts are whole there, and only the best k of its items leave it. Baskets are stored, and go out to the tiles of
some blocks at a time, so that the disk holds a few copies of the entries, however many the tiles ask for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.vectors import co_rating_similarity
from shelfsense.operators.ranking import top_per_key
from shelfsense.operators.strips import spans
from shelfsense.shared import settled, settled_alone

#: Items that a part of a basket holds about; users whose baskets are cut at most, which bounds the list of them.
PART_ITEMS, MOST_HEAVY = 1024, 100_000
#: Pairs that a task counts before it hands them on, which with as many entries of baskets is what it holds (about 100
#: bytes a pair), so two parts of a basket may not have more; pairs that a task should have to count in all.
PAIRS_AT_ONCE, PAIRS_PER_TASK = 1_000_000, 20_000_000
#: Tasks for counting at most, whatever the number of pairs.
MOST_TASKS = 100_000
#: Entries of baskets that a tile holds about; rows of lists that are handed on at a time.
BLOCK_ENTRIES, BATCH_ROWS = 8_000_000, 65_536
#: Entries that are shuffled in a pass at most: so many, or so many times the entries of all baskets if that is more.
PASS_ENTRIES, PASS_SHARE = 100_000_000, 4
#: Items of a basket from which it is cut for tiles; entries that a row of packed baskets holds about.
PIECE_ITEMS, ENTRIES_PER_ROW = 16_384, 1_000_000
PARTIAL_SCHEMA = "product1 bigint, product2 bigint, common bigint, nor1 bigint, nor2 bigint"
#: Many baskets in a row: items that own pairs, by basket, and their partners, where these are others. Sizes of the
#: baskets, then for each entry the item, its raters, and its times (null: once), as ``_bytes``.
BASKET_COLUMNS = ("own_n", "own", "own_raters", "own_w", "n", "item", "raters", "w")
BASKETS = ", ".join(f"{c} binary" for c in BASKET_COLUMNS)


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return lists.flatten(), np.diff(lists.offsets.to_numpy())


def _steps(n_pairs: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of rows with at most ``limit`` pairs together, but at least one row each."""
    done = np.concatenate([[0], np.cumsum(n_pairs)])
    start = 0
    while start < len(n_pairs):
        stop = max(start + 1, int(np.searchsorted(done, done[start] + limit, "right")) - 1)
        yield slice(start, stop)
        start = stop


def _pairs_of(n_left: np.ndarray, n_right: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the flat left and right items of all pairs of every row; of a ``whole`` basket each pair once."""
    left_at = np.cumsum(n_left) - n_left
    right_at = np.cumsum(n_right) - n_right
    row = np.repeat(np.arange(len(n_left)), n_left)
    inside = np.arange(len(row)) - left_at[row]
    first = right_at[row] + np.where(whole[row], inside + 1, 0)
    entry, at = spans(first, right_at[row] + n_right[row] - first)
    return entry, at


def partial_counts(weighted: bool, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batches (l, r) of basket rows -> counted pairs, smaller item first, at most ``limit`` pairs at a time.

    ``l`` and ``r`` list (item, raters, times); an empty ``r`` stands for the pairs within ``l``.
    """

    def counted(items: np.ndarray, raters: np.ndarray, times: np.ndarray, one: np.ndarray, two: np.ndarray):
        known, place = np.unique(items, return_inverse=True)
        of = np.empty(len(known), np.int64)
        of[place] = raters
        key, b = place[one], place[two]
        low = np.minimum(key, b)
        np.maximum(key, b, out=key)
        del b
        low *= len(known)
        key += low
        del low
        if weighted:
            order = np.argsort(key, kind="stable")
            key, step = key[order], (times[one] * times[two])[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, common = key[starts], np.add.reduceat(step, starts)
        elif len(known) ** 2 <= 4 * len(key):
            common = np.bincount(key)
            key = np.flatnonzero(common)
            common = common[key]
        else:
            key.sort()
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, common = key[starts], np.diff(np.append(starts, len(key)))
        a, b = np.divmod(key, len(known))
        columns = [known[a], known[b], common, of[a], of[b]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["product1", "product2", "common", "nor1", "nor2"]
        )

    def numbers(entries: pa.Array) -> tuple[np.ndarray, ...]:
        return tuple(entries.field(i).to_numpy(zero_copy_only=False) for i in range(3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = entries = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            (left, n_left), (right, n_right) = (_flat(table[c].chunk(0)) for c in ("l", "r"))
            whole = n_right == 0
            n_pairs = np.where(whole, n_left * (n_left - 1) // 2, n_left * n_right)
            left_end, right_end = (np.concatenate([[0], np.cumsum(n)]) for n in (n_left, n_right))
            left, right = numbers(left), numbers(right)
            for some in _steps(n_pairs, limit):
                ls = slice(left_end[some.start], left_end[some.stop])
                rs = slice(right_end[some.start], right_end[some.stop])
                # within a whole basket the right items are its own
                alone = whole[some]
                n_l, n_r = n_left[some], n_right[some]
                items = [np.concatenate([a[ls], b[rs]]) for a, b in zip(left, right, strict=True)]
                one, two = [], []
                if alone.any():
                    n = np.where(alone, n_l, 0)
                    at = np.flatnonzero(np.repeat(alone, n_l))
                    e, p = _pairs_of(n[alone], n[alone], np.ones(int(alone.sum()), bool))
                    one.append(at[e])
                    two.append(at[p])
                if not alone.all():
                    crossed = np.flatnonzero(np.repeat(~alone, n_l))
                    e, p = _pairs_of(n_l[~alone], n_r[~alone], np.zeros(int((~alone).sum()), bool))
                    one.append(crossed[e])
                    two.append(int(n_l.sum()) + p)
                one, two = (x[0] if len(x) == 1 else np.concatenate(x) for x in (one, two))
                if len(one):
                    yield counted(*items, one, two)

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                (_, n_left), (_, n_right) = (_flat(part.column(c)) for c in ("l", "r"))
                held.append(part)
                waiting += int(np.where(n_right == 0, n_left * (n_left - 1) // 2, n_left * n_right).sum())
                entries += int(n_left.sum() + n_right.sum())
                # baskets of few items have fewer pairs than entries
                if max(waiting, entries) >= limit:
                    yield from flushed()
                    held, waiting, entries = [], 0, 0
        if held:
            yield from flushed()

    return run


def _incidence(ratings: DataFrame, dedupe: bool) -> DataFrame:
    """One row per (user, item); ``w`` is 1, or the number of rating rows when they all count."""
    pairs = ratings.select("userId", F.col("productId").cast("bigint").alias("item"))
    pairs = pairs.where("userId IS NOT NULL AND item IS NOT NULL").groupBy("userId", "item")
    if dedupe:
        return pairs.agg(F.lit(1).cast("bigint").alias("w"))
    return pairs.agg(F.count(F.lit(1)).alias("w"))


def _listed(sizes: DataFrame, in_heavy: float, part_items: int) -> DataFrame:
    """(userId, parts) of the users whose baskets are cut, at most ``MOST_HEAVY``."""
    # a listed user holds more than one in MOST_HEAVY of the items of all heavy users, so that they are at most so many
    least = max(part_items, -(-in_heavy // MOST_HEAVY))
    return sizes.where(F.col("n") > least).select("userId", F.ceil(F.col("n") / part_items).cast("int").alias("parts"))


def _raters(incidence: DataFrame) -> DataFrame:
    return incidence.groupBy("item").agg(F.sum("w").alias("raters"))


def _sizes(incidence: DataFrame) -> DataFrame:
    return incidence.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))


def _baskets(
    incidence: DataFrame,
    part_items: int,
    tasks: int | None,
    raters: DataFrame | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """(l, r): a row for the basket of a user, or for every pair of its parts where it has several.

    ``raters`` and ``sizes`` are given where they are stored already.
    """
    raters = _raters(incidence) if raters is None else raters
    sizes = _sizes(incidence) if sizes is None else sizes
    n = F.col("n").cast("double")
    known = sizes.agg(
        F.sum(n * (n - 1) / 2).alias("pairs"), F.sum(F.when(F.col("n") > part_items, F.col("n"))).alias("in_heavy")
    ).first()
    listed = _listed(sizes, known["in_heavy"] or 0, part_items)
    if tasks is None:
        cores = incidence.sparkSession.sparkContext.defaultParallelism
        tasks = min(MOST_TASKS, max(cores, math.ceil((known["pairs"] or 0) / PAIRS_PER_TASK)))
    parts = F.coalesce("parts", F.lit(1))
    cut = (
        incidence.join(raters, "item")
        .join(F.broadcast(listed), "userId", "left")
        .withColumn("part", F.pmod(F.xxhash64("item"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(
            "userId",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            (F.col("part") <= F.col("other")).alias("is_left"),
            F.struct("item", "raters", "w").alias("entry"),
        )
    )
    lists = (
        cut.repartition(tasks, "userId", "low", "high")
        .groupBy("userId", "low", "high")
        .agg(
            F.collect_list(F.when(F.col("is_left"), F.col("entry"))).alias("l"),
            F.collect_list(F.when(~F.col("is_left"), F.col("entry"))).alias("r"),
        )
    )
    # an empty side of two parts has no pairs; a basket of one item has none either
    return lists.where("(low = high AND size(l) > 1) OR (size(l) > 0 AND size(r) > 0)").select("l", "r")


def partial_pairs(
    ratings: DataFrame, dedupe: bool = True, part_items: int | None = None, tasks: int | None = None
) -> DataFrame:
    """(product1 < product2, common, nor1, nor2) with the counts still to be added up."""
    incidence = settled(_incidence(ratings, dedupe))
    baskets = _baskets(incidence, part_items or PART_ITEMS, tasks)
    return baskets.mapInArrow(partial_counts(not dedupe, PAIRS_AT_ONCE), PARTIAL_SCHEMA)


def _added(key: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its ``times``, or how often it occurs."""
    if not len(key):
        return key, np.zeros(0, np.int64)
    if times is None:
        key.sort()
    else:
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[starts], np.diff(np.append(starts, len(key))) if times is None else np.add.reduceat(times, starts)


def _among_best(item: np.ndarray, other: np.ndarray, r: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` rows of highest ``r`` per item, equal ones by ascending ``other``; items are together."""
    starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    sizes = np.diff(np.append(starts, len(item)))
    # k stretches of an item hold k different rows, so the least of their best is not above its k-th best
    n = np.where(sizes >= k, k, 1)
    at = np.cumsum(n) - n
    nth = np.arange(int(n.sum())) - np.repeat(at, n)
    bests = np.maximum.reduceat(r, np.repeat(starts, n) + nth * np.repeat(sizes, n) // np.repeat(n, n))
    bound = np.where(sizes >= k, np.minimum.reduceat(bests, at), -np.inf)
    some = np.flatnonzero(r >= np.repeat(bound, sizes))
    order = some[np.lexsort((other[some], -r[some], item[some]))]
    item = item[order]
    starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
    return order[rank < k]


def _bytes(a: np.ndarray) -> bytes:
    """Numbers from zero up, in as few bytes each as the largest needs."""
    kind = np.min_scalar_type(a.max()) if len(a) else np.dtype(np.uint8)
    return bytes([kind.itemsize]) + a.astype(kind).tobytes()


def _numbers(cell: pa.Scalar) -> np.ndarray | None:
    held = cell.as_buffer()
    return None if held is None else np.frombuffer(held, f"u{held[0]}", offset=1)


def _mixed(offsets: np.ndarray) -> np.ndarray:
    """Hashes of 64 bits (splitmix), the same in every task."""
    x = offsets.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _dealt(hashes: np.ndarray, n: int) -> np.ndarray:
    """A number below ``n`` from the upper half of each hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _baskets_of(row: dict[str, pa.Scalar]) -> list[np.ndarray | None]:
    """The columns of ``BASKETS``; partners that are not given are the owners."""
    columns = [_numbers(row[c]) for c in BASKET_COLUMNS]
    return columns if columns[4] is not None else columns[:4] * 2


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(len(batch)):
            yield {c: batch.column(c)[i] for c in batch.schema.names}


def _batch(rows: list[list[bytes | None]], **others: pa.Array) -> pa.RecordBatch:
    columns = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays([*others.values(), *columns], [*others, *BASKET_COLUMNS])


def packed_baskets(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``_pieces`` that Spark dealt out by user and piece -> rows of ``BASKETS``, each with many baskets.

    Items are numbers from ``least`` up. Baskets of one item are left out, as they have no pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if len(batch)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        user = table["userId"].combine_chunks().dictionary_encode()
        user = (user.combine_chunks() if isinstance(user, pa.ChunkedArray) else user).indices.to_numpy()
        piece, item, raters = (table[c].to_numpy() for c in ("piece", "item", "raters"))
        times = table["w"].to_numpy() if "w" in table.column_names else None
        offset = item.astype(np.int64).view(np.uint64) - np.array(least, np.int64).view(np.uint64)
        del table, item

        def rows(some: np.ndarray, key: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray | None]]:
            order = some[np.lexsort([x[some] for x in key])]
            change = np.zeros(len(order), bool)
            change[:1] = True
            for x in key:
                change[1:] |= x[order][1:] != x[order][:-1]
            sizes = np.diff(np.append(np.flatnonzero(change), len(order)))
            return order[change], [sizes, offset[order], raters[order], None if times is None else times[order]]

        def blobs(columns: list[np.ndarray | None]) -> list[bytes | None]:
            return [None if c is None else _bytes(c) for c in columns]

        _, (sizes, *columns) = rows(np.flatnonzero(piece < 0), [user])
        pairs = sizes > 1
        if pairs.any():
            keep = np.repeat(pairs, sizes)
            columns = [None if c is None else c[keep] for c in columns]
            yield _batch([blobs([sizes[pairs], *columns]) + [None] * 4])
        if (piece >= 0).any():
            of = piece >> 1  # the lowest bit tells partners
            owned, owners = rows(np.flatnonzero((piece >= 0) & (piece & 1 == 0)), [of, user])
            asked, partners = rows(np.flatnonzero((piece >= 0) & (piece & 1 == 1)), [of, user])
            # a piece without owners or without partners has no pairs
            both = [
                np.isin((user[x].astype(np.int64) << 32) | of[x], (user[y].astype(np.int64) << 32) | of[y])
                for x, y in ((owned, asked), (asked, owned))
            ]
            found = []
            for (sizes, *columns), fine in zip((owners, partners), both, strict=True):
                keep = np.repeat(fine, sizes)
                found += [sizes[fine], *(None if c is None else c[keep] for c in columns)]
            if len(found[0]):
                yield _batch([blobs(found)])

    return run


def work_by_block(blocks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``BASKETS`` -> (block, pairs): what the owners of each block will be counted with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = np.zeros(blocks)
        for row in _rows(batches):
            own_n, own, _, _, n, *_ = _baskets_of(row)
            work += np.bincount(_dealt(_mixed(own), blocks), np.repeat(n, own_n), blocks)
        block = np.flatnonzero(work)
        yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(work[block].astype(np.int64))], ["block", "pairs"])

    return run


def dealt_to_tiles(
    blocks: int, first: np.ndarray, low: int, high: int, limit: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``BASKETS`` -> such rows for the tiles from ``low`` to before ``high``, about ``limit`` entries at a time.

    Block b has the tiles from ``first[b]`` to before ``first[b + 1]``, among which partners are shared out.
    """
    from_block, to_block = int(np.searchsorted(first, low, "right")) - 1, int(np.searchsorted(first, high))
    ways = np.diff(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own_n, own, own_raters, own_times, n, item, raters, times = _baskets_of(row)
            own_n, n = own_n.astype(np.int64), n.astype(np.int64)
            begins = np.cumsum(n) - n
            block = _dealt(_mixed(own), blocks)
            at = np.flatnonzero((block >= from_block) & (block < to_block))
            block = block[at]
            order = np.argsort((block - from_block).astype(np.min_scalar_type(to_block - from_block)), kind="stable")
            at, block = at[order], block[order]
            basket = np.repeat(np.arange(len(own_n)), own_n)[at]
            # a hit is a basket with items of a block; its owners stay together
            hit = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (basket[1:] != basket[:-1])]))
            if not len(at):
                continue
            hit_n, hit_block, hit_basket = np.diff(np.append(hit, len(at))), block[hit], basket[hit]
            for some in _steps(n[hit_basket], limit):
                entry, of = spans(begins[hit_basket[some]], n[hit_basket[some]])
                entry += some.start
                tile = first[hit_block[entry]]
                parts = ways[hit_block[some]]
                if (parts > 1).any():
                    share = (_mixed(item[of]) & np.uint64(0xFFFFFFFF)) * ways[hit_block[entry]].astype(np.uint64)
                    tile = tile + (share >> np.uint64(32)).astype(np.int64)
                    order = np.argsort(tile, kind="stable")
                    order = order[(tile[order] >= low) & (tile[order] < high)]
                    entry, of, tile = entry[order], of[order], tile[order]
                    if not len(tile):
                        continue
                start = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (entry[1:] != entry[:-1])]))
                whose = entry[start]
                _, owner = spans(hit[whose], hit_n[whose])
                owner = at[owner]
                sizes = np.diff(np.append(start, len(tile)))
                owner_end = np.append(0, np.cumsum(hit_n[whose]))
                tiles = np.flatnonzero(np.concatenate([[True], tile[start][1:] != tile[start][:-1]]))
                found = []
                for a, b in zip(tiles, np.append(tiles[1:], len(start)), strict=True):
                    mine = owner[owner_end[a] : owner_end[b]]
                    theirs = of[start[a] : start[b] if b < len(start) else len(of)]
                    found.append(
                        [_bytes(hit_n[whose[a:b]]), _bytes(own[mine]), _bytes(own_raters[mine])]
                        + [None if own_times is None else _bytes(own_times[mine])]
                        + [_bytes(sizes[a:b]), _bytes(item[theirs]), _bytes(raters[theirs])]
                        + [None if times is None else _bytes(times[theirs])]
                    )
                yield _batch(found, tile=pa.array((tile[start[tiles]] - low).astype(np.int32)))

    return run


def best_of_tile(k: int, limit: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``BASKETS`` of one tile -> the best ``k`` partners of every owner, whose counts are whole there.

    About ``limit`` pairs are spread out at a time. Items are numbers from ``least`` up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_baskets_of(row) for row in _rows(batches)]
        if not held:
            return
        weighted = held[0][3] is not None
        own_n, own, own_raters, own_times, n, item, raters, times = (
            None if c[0] is None else np.concatenate(c) for c in zip(*held, strict=True)
        )
        del held
        # a pair is one number: the owner's among those of a step, then the partner and its raters
        rater_bits = int(max(own_raters.max(), raters.max())).bit_length()
        bits = int(max(own.max(), item.max())).bit_length() + rater_bits
        if bits + int(limit).bit_length() <= 64:
            shift, mask = np.uint64(rater_bits), np.uint64((1 << rater_bits) - 1)
            kind = np.uint32 if bits <= 32 else np.uint64
            codes = (item.astype(kind) << kind(rater_bits)) | raters.astype(kind)
            own = (own.astype(np.uint64) << shift) | own_raters

            def decoded(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                return code >> shift, (code & mask).astype(np.int64)

        else:  # ids too far apart: numbered within the tile
            known, places = np.unique(np.concatenate([own, item]).astype(np.uint64), return_inverse=True)
            of = np.empty(len(known), np.int64)
            of[places] = np.concatenate([own_raters, raters])
            own, codes = places[: len(own)].astype(np.uint64), places[len(own) :].astype(np.uint64)
            bits = len(known).bit_length()

            def decoded(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                return known[code], of[code]

        del item, raters, own_raters
        own_n, n = own_n.astype(np.int64), n.astype(np.int64)
        basket = np.repeat(np.arange(len(own_n)), own_n)
        order = np.argsort(own, kind="stable")
        own, basket = own[order], basket[order]
        begins, n_pairs = (np.cumsum(n) - n)[basket], n[basket]
        if weighted:
            own_times, times = own_times[order].astype(np.int64), times.astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ends = np.append(starts[1:], len(own))
        nth = np.repeat(np.arange(len(starts)), ends - starts)
        waiting, n_waiting = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            columns = [pa.array(np.concatenate(c)) for c in zip(*waiting, strict=True)]
            found = pa.RecordBatch.from_arrays(columns, ["product1", "product2", "common", "nor1", "nor2"])
            for at in range(0, len(found), BATCH_ROWS):
                yield found.slice(at, BATCH_ROWS)

        for some in _steps(np.add.reduceat(n_pairs, starts), limit):
            first, key, common = starts[some.start], np.zeros(0, np.uint64), np.zeros(0, np.int64)
            # several rounds only where one item alone has more pairs than the limit
            for part in _steps(n_pairs[first : ends[some.stop - 1]], limit):
                entries = slice(first + part.start, first + part.stop)
                lengths = n_pairs[entries]
                at = np.repeat(begins[entries] - (np.cumsum(lengths) - lengths), lengths)
                at += np.arange(len(at))
                new = np.repeat((nth[entries] - some.start).astype(np.uint64) << np.uint64(bits), lengths)
                new |= codes[at]
                new, new_times = _added(new, np.repeat(own_times[entries], lengths) * times[at] if weighted else None)
                del at
                if len(key):
                    new, new_times = _added(np.append(key, new), np.append(common, new_times))
                key, common = new, new_times
            owner = (key >> np.uint64(bits)).astype(np.int64)
            code = key & np.uint64((1 << bits) - 1)
            mine = own[starts[some]][owner]
            other = code != mine
            if not other.any():
                continue
            owner, code, mine, common = owner[other], code[other], mine[other], common[other]
            (one, nor1), (two, nor2) = decoded(mine), decoded(code)
            top = _among_best(owner, code, common / np.sqrt(nor1.astype(np.float64) * nor2), k)
            ids = [(x[top] + np.array(least, np.int64).view(np.uint64)).view(np.int64) for x in (one, two)]
            waiting.append((*ids, common[top], nor1[top], nor2[top]))
            n_waiting += len(top)
            if n_waiting >= BATCH_ROWS:
                yield from flushed()
                waiting, n_waiting = [], 0
        if waiting:
            yield from flushed()

    return run


def _pieces(incidence: DataFrame, raters: DataFrame, listed: DataFrame, weighted: bool) -> DataFrame:
    """(userId, piece, item, raters, w): whole baskets as piece -1, those of listed users as pieces.

    A piece is a part whose items own the pairs and a part of their partners, its number doubled, and one more for them.
    """
    cut = incidence.join(raters, "item").join(F.broadcast(listed), "userId", "left")
    cut = cut.withColumn("part", F.pmod(F.xxhash64("item"), F.coalesce("parts", F.lit(1))))
    pieces = F.expr(
        "CASE WHEN parts IS NULL THEN array(-1L) ELSE flatten(transform(sequence(0L, parts - 1L), other -> "
        "array(2 * (part * parts + other), 2 * (other * parts + part) + 1))) END"
    )
    return cut.select("userId", F.explode(pieces).alias("piece"), "item", "raters", *(["w"] if weighted else []))


def _tiles(pieces: DataFrame, rows: int, k: int, least: int, most: int, tasks: int, blocks: int) -> DataFrame:
    """(product1, product2, common, nor1, nor2): the best ``k`` of every item, or of every tile of its block.

    Baskets are stored packed. In each of several passes they are read, and what the tiles of some blocks need of them,
    ``most`` entries at most, is shuffled; the files of that are gone before the next pass.
    """
    dealt = min(MOST_TASKS, max(tasks, math.ceil(rows / ENTRIES_PER_ROW)))
    # owners and partners of a piece meet
    together = pieces.repartition(dealt, "userId", F.shiftright("piece", 1))
    baskets = settled_alone(together.mapInArrow(packed_baskets(least), BASKETS))
    measured = baskets.mapInArrow(work_by_block(blocks), "block bigint, pairs bigint")
    work = np.zeros(blocks, np.int64)
    for row in measured.groupBy("block").agg(F.sum("pairs").alias("pairs")).collect():
        work[row["block"]] = row["pairs"]
    # a block is shared out where items of many raters give it far more than others have
    ways = np.maximum(1, np.minimum(work // max(BLOCK_ENTRIES, int(work.sum()) // blocks), MOST_TASKS))
    first = np.append(0, np.cumsum(ways))
    passes = list(_steps(np.repeat(work // ways, ways), most))
    lists = []
    for some in passes:
        tiles = baskets.mapInArrow(dealt_to_tiles(blocks, first, some.start, some.stop, PAIRS_AT_ONCE), f"tile int, {BASKETS}")
        tiles = tiles.repartitionById(some.stop - some.start, F.col("tile"))
        best = tiles.mapInArrow(best_of_tile(k, PAIRS_AT_ONCE, least), PARTIAL_SCHEMA)
        lists.append(best if len(passes) == 1 else settled_alone(best))
    return reduce(DataFrame.unionByName, lists)


def _best_pairs(ratings: DataFrame, k: int, dedupe: bool, part_items: int | None, tasks: int | None) -> DataFrame:
    """Both ways, sums of partial counts of all pairs, or, where these would save nothing, the best ``k`` by tiles.

    ``part_items`` asks for partial counts of baskets in such parts.
    """
    incidence, raters, sizes = settled_alone(_incidence(ratings, dedupe)), None, None
    if part_items is None:
        raters, sizes = settled_alone(_raters(incidence)), settled_alone(_sizes(incidence))
        n = F.col("n").cast("double")
        known = sizes.agg(
            F.sum("n").alias("entries"),
            F.sum(n * (n - 1) / 2).alias("pairs"),
            F.sum(F.when(F.col("n") > PIECE_ITEMS, F.col("n"))).alias("in_heavy"),
        ).first()
        items = raters.agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("least")).first()
        entries, pairs = known["entries"] or 0, known["pairs"] or 0
        wanted = tasks or max(incidence.sparkSession.sparkContext.defaultParallelism, math.ceil(pairs / PAIRS_PER_TASK))
        wanted = min(MOST_TASKS, wanted)
        # a step hands on a pair of items once
        if 0 < pairs < items["n"] ** 2 / 2 * (wanted + pairs / PAIRS_AT_ONCE):
            listed = _listed(sizes, known["in_heavy"] or 0, PIECE_ITEMS)
            cut = sizes.join(F.broadcast(listed), "userId").agg(F.sum(2 * F.col("n") * F.col("parts")).alias("rows")).first()
            pieces = _pieces(incidence, raters, listed, not dedupe)
            # a tile holds the baskets of its items: pairs both ways, and every item with itself
            blocks = min(MOST_TASKS, max(wanted, math.ceil((2 * pairs + entries) / BLOCK_ENTRIES)))
            most = max(PASS_ENTRIES, PASS_SHARE * entries)
            return _tiles(pieces, entries + (cut["rows"] or 0), k, items["least"], most, wanted, blocks)
    baskets = _baskets(incidence, part_items or PART_ITEMS, tasks, raters, sizes)
    return _both_ways(_summed(baskets.mapInArrow(partial_counts(not dedupe, PAIRS_AT_ONCE), PARTIAL_SCHEMA)))


def _summed(partial: DataFrame) -> DataFrame:
    return partial.groupBy("product1", "product2").agg(
        F.sum("common").alias("common"), F.first("nor1").alias("nor1"), F.first("nor2").alias("nor2")
    )


def _both_ways(summed: DataFrame) -> DataFrame:
    one, two = F.col("product1"), F.col("product2")
    names = ("product1", "product2", "nor1", "nor2")
    ways = [F.struct(*(c.alias(n) for c, n in zip(cols, names, strict=True))) for cols in (
        (one, two, F.col("nor1"), F.col("nor2")),
        (two, one, F.col("nor2"), F.col("nor1")),
    )]
    return summed.select(F.explode(F.array(*ways)).alias("p"), "common").select(
        "p.product1", "p.product2", "common", "p.nor1", "p.nor2"
    )


def co_rating_counts(
    ratings: DataFrame, dedupe: bool = True, part_items: int | None = None, tasks: int | None = None
) -> DataFrame:
    """(product1, product2, common, nor1, nor2) for every ordered pair rated by a common user."""
    return _both_ways(_summed(partial_pairs(ratings, dedupe, part_items, tasks)))


def with_similarity(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn(
        "r", co_rating_similarity(F.col("common"), F.col("nor1"), F.col("nor2"))
    )


def similar_by_co_rating(
    ratings: DataFrame,
    k: int = 5,
    dedupe: bool = True,
    part_items: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """(productId, rid, r, rank): the ``k`` most similar items of every item.

    ``dedupe`` counts a user once per item; without it every rating row counts, as do all row pairs.
    """
    pairs = with_similarity(_best_pairs(ratings, k, dedupe, part_items, tasks))
    return top_per_key(
        pairs.select(F.col("product1").alias("productId"), F.col("product2").alias("rid"), "r"),
        "productId",
        k,
    )
