"""Best-k partners of sparse vectors through an inverted index: rows meet only under terms that can matter.

Vectors have length one and list their terms from rare to frequent. A row asks the postings of its first terms only:
what all others can add to a product is at most the length of the vector's remainder (both vectors have length one),
so once that lies below the k-th best product known, a partner that shares nothing but the remainder cannot be listed.
A first pass over the rarest terms finds k products, a second one asks the terms which that leaves open.

The postings of a term are read as tiles (see ``strips``): candidate pairs never become rows, and a term in any share
of the vectors is cut into strips of askers and chunks of postings. Whole vectors travel with a posting, so a product
is computed once, in one piece.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.operators.ranking import top_per_key
from shelfsense.operators.strips import CHUNK_ROWS, STRIP_ROWS, SparseStrip, best_partners
from shelfsense.shared import settled

#: Lists are ranked by products of six digits; a bound must clear a known product by more than their rounding.
DIGITS, MARGIN = 6, 2e-6
#: The first pass asks terms until their postings hold this many times k rows.
FIRST_READ = 4


def _terms_read(rows_wanted: int) -> Column:
    """How many leading terms have postings of ``rows_wanted`` rows together; all, if too few."""
    read = F.aggregate(
        "uses",
        F.struct(F.lit(0).alias("terms"), F.lit(0).cast("bigint").alias("rows")),
        lambda a, use: F.when(a["rows"] >= rows_wanted, a).otherwise(
            F.struct((a["terms"] + 1).alias("terms"), (a["rows"] + use).alias("rows"))
        ),
    )
    return read["terms"]


def _terms_open(floor: Column) -> Column:
    """How many leading terms must be asked: the remainder behind them is no longer than ``floor``."""
    return F.expr("size(weights)") - F.aggregate(
        F.reverse("weights"),
        F.struct(F.lit(0).alias("closed"), F.lit(0.0).alias("square")),
        lambda a, w: F.struct(
            F.when(a["square"] + w * w <= floor * floor, a["closed"] + 1).otherwise(a["closed"]).alias("closed"),
            (a["square"] + w * w).alias("square"),
        ),
    )["closed"]


def _asked(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """(id, terms, weights, term, uses): a row for each term at the positions ``first`` <= position < ``last``."""
    pairs = F.slice(F.arrays_zip("terms", "uses"), first + 1, F.greatest(last - first, F.lit(0)))
    return rows.select("id", "terms", "weights", F.explode(pairs).alias("p")).select(
        "id", "terms", "weights", F.col("p.terms").alias("term"), F.col("p.uses").alias("uses")
    )


def compared_pairs(asked: DataFrame) -> int:
    """Pairs of a row and a posting that the asked terms bring together."""
    return asked.agg(F.sum("uses")).first()[0] or 0


def _meet(asked: DataFrame, rows: DataFrame, k: int, strip_rows: int, chunk_rows: int) -> DataFrame:
    """(id, rid, r): the best k of every asking row in each tile; AQE splits a frequent term in the joins."""
    load = asked.groupBy("term").agg(F.count(F.lit(1)).alias("askers"), F.max("uses").alias("found"))
    cuts = load.select(
        "term",
        F.ceil(F.col("askers") / strip_rows).cast("int").alias("_strips"),
        F.ceil(F.col("found") / chunk_rows).cast("int").alias("_chunks"),
    )

    def side(df: DataFrame, number: int, own: str, other: str) -> DataFrame:
        return (
            df.select("id", "terms", "weights", "term")
            .join(cuts, "term")
            .withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .select(
                F.xxhash64("term", "_strip", "_chunk").alias("tile"), F.lit(number).alias("side"), "id", "terms", "weights"
            )
        )

    postings = rows.select("id", "terms", "weights", F.explode("terms").alias("term"))
    tiles = side(asked, 0, "_strip", "_chunk").unionByName(side(postings, 1, "_chunk", "_strip"))
    return (
        tiles.repartition("tile")
        .sortWithinPartitions("tile", "side", "id")
        .mapInArrow(best_partners(SparseStrip, k, 0.0, DIGITS, False), "id bigint, rid bigint, r double")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """A pair is found under every asked term it shares and counts once."""
    return top_per_key(found.groupBy("id", "rid").agg(F.max("r").alias("r")), "id", k)


def first_asked(rows: DataFrame, k: int) -> DataFrame:
    return _asked(rows, F.lit(0), _terms_read(FIRST_READ * k))


def then_asked(rows: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """What the first pass leaves open; ``known`` (id, rid, r) are its lists."""
    floors = known.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.min("r")).alias("kth"))
    floor = F.greatest(F.coalesce("kth", F.lit(0.0)) - MARGIN, F.lit(0.0))
    return _asked(rows.join(floors, "id", "left"), _terms_read(FIRST_READ * k), _terms_open(floor))


def top_by_terms(
    rows: DataFrame, k: int, n: int, strip_rows: int = STRIP_ROWS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(id, rid, r, rank): for each of the ``n`` rows the ``k`` of largest positive product, itself included.

    ``rows`` (id, terms, weights, uses) are read several times and should be stored; ``uses`` is the number of rows
    with the term and rises along a row. Products are rounded to six digits, equal ones go by smaller id.
    """
    strip_rows = min(strip_rows, max(256, math.ceil(n / rows.sparkSession.sparkContext.defaultParallelism)))
    known = settled(_best(_meet(first_asked(rows, k), rows, k, strip_rows, chunk_rows), k).drop("rank"))
    more = _meet(then_asked(rows, known, k), rows, k, strip_rows, chunk_rows)
    return _best(known.unionByName(more), k)
