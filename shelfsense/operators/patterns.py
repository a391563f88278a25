"""Which rows a table of patterns can match: an index over three-letter pieces of the searched text.

A pattern is looked up by one piece of text that every match must hold, the rarest of those it names, and only the rows
with that piece try it. Pieces are taken from a pattern where that is certain: escapes, classes, groups, optional and
wild characters end a piece, and flags, alternatives and escapes of unusual letters give the pattern none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.operators.joins import join_unique

PIECE = 3
_BREAK = "\x00"


def pieces(text: Column) -> Column:
    """The distinct three-letter pieces of a text; none of a shorter one."""
    starts = F.when(F.length(text) >= PIECE, F.sequence(F.lit(1), F.length(text) - (PIECE - 1)))
    return F.array_distinct(F.coalesce(F.transform(starts, lambda i: F.substr(text, i, F.lit(PIECE))), F.array().cast("array<string>")))


def required_pieces(pattern: Column) -> Column:
    """Pieces that stand in every text the regular expression matches; an empty array where none is certain."""
    unsure = pattern.rlike(r"\\[a-zA-Z0-9&&[^dDwWsSbB]]|\(\?[a-zA-Z-]+[):]|\x00")
    rest = F.regexp_replace(pattern, r"(?s)\\.", _BREAK)
    rest = F.regexp_replace(rest, r"\[[^\[\]]*\]", _BREAK)
    for _ in range(4):  # innermost groups first; what is nested deeper counts as unsure
        rest = F.regexp_replace(rest, r"\([^()]*\)", _BREAK)
    rest = F.regexp_replace(rest, r"(?s).(?:[?*]|\{[^}]*\})[?+]?", _BREAK)
    rest = F.regexp_replace(rest, r"[+^$.]", _BREAK)
    unsure = unsure | rest.rlike(r"[\[\]()|{}?*\\]")
    found = F.array_distinct(F.flatten(F.transform(F.split(rest, _BREAK), pieces)))
    return F.when(unsure, F.array().cast("array<string>")).otherwise(found)


def _in_blocks(wanted: DataFrame, key: str, block: int) -> DataFrame:
    """(key, _block, _blocks, _patterns): a key's patterns in blocks of about ``block``."""
    counts = wanted.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    return (
        wanted.join(counts, key)
        .withColumn("_block", F.pmod(F.xxhash64("pattern"), F.col("_blocks")).cast("int"))
        .groupBy(key, "_blocks", "_block")
        .agg(F.collect_list("pattern").alias("_patterns"))
    )


def rarest_pieces(texts: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """(pattern, _piece, _rows): each pattern's required piece that the fewest rows of ``texts`` hold, with their number.

    A pattern without a required piece has none here. Rows are counted for pieces that some pattern names.
    """
    named = wanted.select("pattern", F.explode(required_pieces(F.col("pattern"))).alias("_piece"))
    held = texts.select(F.explode(pieces(F.col(column))).alias("_piece"))
    counts = held.join(named.select("_piece").distinct(), "_piece", "left_semi").groupBy("_piece").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    rows = F.coalesce("_rows", F.lit(0).cast("bigint"))
    choice = F.min(F.struct(rows.alias("_rows"), "_piece")).alias("_best")
    return named.join(counts, "_piece", "left").groupBy("pattern").agg(choice).select(
        "pattern", F.col("_best._piece").alias("_piece"), F.col("_best._rows").alias("_rows")
    )


def matches(texts: DataFrame, column: str, patterns: DataFrame, block: int = 32) -> DataFrame:
    """(pattern, columns of ``texts``) for every distinct pattern found in the text ``column``.

    A row meets, per piece it holds, the patterns looked up by that piece, ``block`` at a time, and tries them in place.
    Patterns without a required piece are tried on every row. A piece in any share of the rows is dealt to several parts.
    """
    columns = texts.columns
    wanted = patterns.where("pattern IS NOT NULL").select("pattern").distinct()
    chosen = rarest_pieces(texts, column, wanted)
    hits = F.filter("_patterns", lambda p: F.rlike(F.col(column), p))

    def tried(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(hits).alias("pattern"), *columns)

    by_piece = _in_blocks(chosen, "_piece", block)
    met = by_piece.select("_piece", "_blocks").distinct()
    holding = texts.select("*", F.explode(pieces(F.col(column))).alias("_piece"))
    # the same piece's blocks are few and a row of each is dealt by itself
    asked = join_unique(holding, met, "_piece", apart=columns).withColumn(
        "_cell", F.explode(F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda b: F.struct(F.col("_piece"), b.alias("b"))))
    )
    cells = by_piece.select(F.struct("_piece", F.col("_block").alias("b")).alias("_cell"), "_patterns")
    looked_up = tried(join_unique(asked.select(*columns, "_cell"), cells, "_cell", apart=columns))

    sweeping = wanted.where(F.size(required_pieces(F.col("pattern"))) == 0)
    blocks = max(1, -(-sweeping.count() // block))
    everywhere = sweeping.groupBy(F.pmod(F.xxhash64("pattern"), F.lit(blocks)).cast("int").alias("_block")).agg(
        F.collect_list("pattern").alias("_patterns")
    )
    by_block = texts.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return looked_up.unionByName(tried(by_block.join(everywhere, "_block")))
