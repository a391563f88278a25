"""Mixing sources to target weights by a splitting tree over blocks.

Documents of a source are dealt to blocks by hash, and its blocks stand in a permuted order. A source whose target
is e times its words is taken ``floor(e)`` times whole, and once more as far as the last share of its target goes:
that many blocks from the front of the permuted order, the last of them document by document, and one document in
part, so that the words taken equal the target rounded. A splitting tree then parts the blocks of
every epoch, whole or partial, among output shards: of each epoch a random half of a node's blocks goes left, so that
the blocks that a child gets of each source follow the multivariate hypergeometric distribution, and the quotas of the
children add up exactly to that of the node. Blocks of an epoch are disjoint; in its next epoch a block is dealt anew.
Within a shard, documents stand in an order of their own, and ``repeated`` gives its rows in that order.

There are at most ``BLOCKS`` blocks and one a source, whatever the size of the corpus, so permuted orders and trees
are small, and a source with any share of the rows is spread over its blocks. Sizes are word counts (words are
``[^\\x20\\x09-\\x0D]+``). Null texts have size 0; the null source is a source of its own, after all others. Rows that
share an id are ordered by text; wholly repeated rows are further documents of the same place in the order, each with
a share of what that place gets. Only DataFrame functions are used; nothing depends on the order of the input rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.shared import settled

#: Weights of the sources in order, repeating; words to take for each word there is; most repeats.
WEIGHTS, BUDGET, EPOCHS = (3, 1, 2), 1.5, 2
#: Blocks of all sources, about, and levels of the splitting tree.
BLOCKS, LEVELS = 8192, 4
WORD = r"[^\x20\x09-\x0D]+"


def _dice(*columns: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, rank, words, target) from (source, words), one row a source.

    A target is the smaller of ``EPOCHS`` times the words and of a level times the weight; the level is the one at
    which all targets add up. Sources are few against documents, so their order is one small sort.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    weighed = (
        sizes.withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("weight", F.get(weights, F.col("rank") % len(WEIGHTS)).cast("double"))
        .withColumn("cap", F.col("words") * F.lit(float(EPOCHS)))
    )
    # sources in the order in which a rising level reaches their caps
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    behind = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("words").over(every) * F.lit(BUDGET) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levels = weighed.withColumn("level", left / F.sum("weight").over(behind))
    # taking a source for full whose cap is above the level, or for open whose cap is below, lowers the level
    target = F.least("cap", F.max("level").over(every) * F.col("weight"))
    return levels.withColumn("target", target).select("source", "rank", "words", "target")


def _dealt(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(id, tie, source, size) of every row; small, and read several times."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("id"),
        F.xxhash64(whole).alias("tie"),
        F.col(source).alias("source"),
        F.regexp_count(whole, F.lit(WORD)).cast("bigint").alias("size"),
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """One row a document: (id, tie, source, size, source_size, target, taken, block, shard, shuffled, shards, places).

    ``tie`` is a hash of the text. ``shards`` are where its block goes in each epoch (``epoch0`` and so on; null: not
    drawn), the partial one last, and ``places`` its place in the order of each of these; ``shard`` and ``shuffled``
    are those of the first epoch.
    """

    def by_epoch(column: str) -> Column:
        return F.struct(*(F.get(column, F.lit(i)).alias(f"epoch{i}") for i in range(EPOCHS))).alias(column)

    mixed = _mixed(docs, key, text, source, seed)
    shards, places = by_epoch("shards"), by_epoch("places")
    return mixed.select(*(c for c in mixed.columns if c not in ("shards", "places")), shards, places)


def _mixed(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """``mix`` with ``shards`` and ``places`` as arrays, as long as epochs draw the block."""
    sized = settled(_dealt(docs, key, text, source))
    sources = settled(
        targets(sized.groupBy("source").agg(F.sum("size").alias("words")))
        .withColumn("share", F.try_divide("words", F.sum("words").over(Window.partitionBy())))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.coalesce("share", F.lit(0.0)) * BLOCKS)).cast("int"))
        # what is left of the target after the whole epochs
        .withColumn("epochs", F.when(F.col("words") > 0, F.floor(F.round("target") / F.col("words"))).otherwise(0))
        .withColumn("partial", (F.round("target") - F.col("epochs") * F.col("words")).cast("bigint"))
    )
    block = F.pmod(_dice("id", "tie", seed=seed), F.col("blocks")).cast("int")
    placed = (
        sized.withColumn("has", F.col("source").isNotNull())
        .withColumn("_name", F.coalesce("source", F.lit("")))
        .drop("source")
        .join(
            sources.withColumn("has", F.col("source").isNotNull()).withColumn("_name", F.coalesce("source", F.lit(""))),
            ["has", "_name"],
        )
        .drop("has", "_name")
        .withColumn("block", block)
    )
    # the drawn blocks: all in whole epochs, in the partial one those before its end in the permuted order of their source
    permuted = Window.partitionBy("rank").orderBy(_dice("rank", "block", seed=seed + 1), "block")
    blocks = (
        placed.groupBy("rank", "block", "epochs", "partial")
        .agg(F.sum("size").alias("block_words"))
        .withColumn("left", F.col("partial") - F.sum("block_words").over(permuted) + F.col("block_words"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs").cast("int"))))
    )
    drawn = (
        _split(blocks.where("(epoch < epochs OR left > 0) AND block_words > 0"), seed + 2)
        .groupBy("rank", "block", "block_words")
        .agg(
            F.max(F.when(F.col("left") > 0, F.col("left"))).alias("left"),
            F.array_sort(F.collect_list(F.struct("epoch", "shard")))["shard"].alias("shards"),
        )
    )
    found = placed.join(drawn, ["rank", "block"], "left")
    # only the last drawn block of a source is taken in part, in an order of its own
    cut = F.col("left") < F.col("block_words")
    inside = Window.partitionBy("rank", "block").orderBy(_dice("id", "tie", seed=seed + 3), "id", "tie")
    ahead = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    parts = (
        found.where(cut)
        .withColumn("ahead", F.coalesce(ahead, F.lit(0)))
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("ahead"))))
        .drop("ahead")
    )
    whole = found.where(F.coalesce(~cut, F.lit(True))).withColumn(
        "part", F.when(F.col("left").isNotNull(), F.col("size")).otherwise(0)
    )
    return whole.unionByName(parts).select(
        "id",
        "tie",
        "source",
        "size",
        F.col("words").alias("source_size"),
        "target",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("bigint").alias("taken"),
        "block",
        F.get("shards", F.lit(0)).alias("shard"),
        F.when(F.col("shards").isNotNull(), _place(F.get("shards", F.lit(0)), F.lit(0), "id", "tie", seed)).alias("shuffled"),
        F.coalesce("shards", F.array().cast("array<int>")).alias("shards"),
        F.coalesce(
            F.transform("shards", lambda shard, epoch: _place(shard, epoch, "id", "tie", seed)), F.array().cast("array<bigint>")
        ).alias("places"),
    )


def _place(shard: Column, epoch: Column, key: str, tie: str, seed: int) -> Column:
    """The place of a document in the order of a shard."""
    return _dice(shard, epoch, key, tie, seed=seed + 4)


def _split(drawn: DataFrame, seed: int) -> DataFrame:
    """``drawn`` blocks with their shard: at each level a random half of a node's blocks of every epoch goes left."""
    nodes = drawn.withColumn("shard", F.lit(0))
    for level in range(LEVELS):
        turn = Window.partitionBy("epoch", "shard").orderBy(_dice("rank", "block", "epoch", seed=seed + 16 * level), "rank", "block")
        of_node = Window.partitionBy("epoch", "shard")
        left = 2 * F.row_number().over(turn) <= F.count(F.lit(1)).over(of_node)
        nodes = nodes.withColumn("_left", left).withColumn("shard", F.col("shard") * 2 + F.when(F.col("_left"), 0).otherwise(1))
    return nodes.drop("_left")


def quotas(mixed: DataFrame, epoch: int = 0) -> DataFrame:
    """(shard, source, blocks): how many blocks of each source, drawn in an epoch, every output shard got."""
    dealt = mixed.withColumn("shard", F.col("shards")[f"epoch{epoch}"]).where("shard IS NOT NULL")
    return dealt.groupBy("shard", "source").agg(F.countDistinct("block").alias("blocks"))


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 1) -> DataFrame:
    """The mix as rows of ``docs``: a document as often as it is taken whole, and the front of one taken in part.

    The words of a part are joined by one space; documents of which nothing is taken go, also those without words.
    Rows come shard by shard, each in its own order; a shard fills several partitions, one after the other, where
    shuffles have more partitions than there are shards.
    """
    mixed = _mixed(docs, key, text, source, seed)
    takes = mixed.where("taken > 0").groupBy("id", "tie", "source").agg(F.min("size").alias("_size"), F.sum("taken").alias("_taken"), F.count(F.lit(1)).alias("_rows"), F.first("shards").alias("_shards"))
    keyed = docs.withColumn("_tie", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = (
        F.col(f"d.{key}").eqNullSafe(F.col("t.id"))
        & (F.col("d._tie") == F.col("t.tie"))
        & F.col(f"d.{source}").eqNullSafe(F.col("t.source"))
    )
    met = keyed.alias("d").join(takes.alias("t"), same)
    # wholly repeated rows share what their place gets, evenly
    own = F.col("_taken") / F.col("_rows")
    times = F.ceil(own / F.col("_size")).cast("int")
    turned = met.withColumn("_turn", F.explode(F.sequence(F.lit(1), times))).withColumn(
        "_words", F.least(F.col("_size"), F.round(own - (F.col("_turn") - 1) * F.col("_size"))).cast("int")
    )
    front = F.array_join(F.slice(F.regexp_extract_all(F.col(f"d.{text}"), F.lit(f"({WORD})")), 1, F.col("_words")), " ")
    cut = F.when(F.col("_words") < F.col("_size"), front).otherwise(F.col(f"d.{text}"))
    columns = [cut.alias(c) if c == text else F.col(f"d.{c}").alias(c) for c in docs.columns]
    # a turn is an epoch; places are hashes, so equal ranges of them part a shard evenly
    shard = F.get("_shards", F.col("_turn") - 1)
    place = _place(shard, F.col("_turn") - 1, "t.id", "t.tie", seed)
    rows = turned.where("_words > 0").select(F.struct(*columns).alias("row"), shard.alias("shard"), place.alias("place"))
    pieces = math.ceil(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) / 2**LEVELS)
    piece = F.floor((F.shiftright("place", 32) + F.lit(2**31)) * F.lit(pieces) / F.lit(2.0**32)).cast("int")
    return (
        rows.repartitionById(pieces * 2**LEVELS, F.col("shard") * pieces + piece)
        .sortWithinPartitions("shard", "place")
        .select(*(F.col("row")[c].alias(c) for c in docs.columns))
    )
