"""Connected components by alternating stars, one reliable checkpoint a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.shared import settled


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b): for every linked node but the smallest of its component, that smallest node.

    ``links`` (a bigint, b bigint) may hold links in either direction, repeated, and of a node with itself.
    A round hangs the larger neighbours of every node on its smallest neighbour, then the smaller ones; the
    number of links never grows and the depth shrinks fast. A hub is joined as one key of a plain join,
    which AQE may split, with minima reduced before they are shuffled.
    """
    edges = settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        roots = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(roots, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .unionByName(roots.withColumnRenamed("m", "b"))
            .distinct()
        )
        edges = settled(small)
        before, state = state, _state(edges)
        if state == before:
            return edges
