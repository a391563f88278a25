"""Exact duplicates by a content sort.

Texts are dealt to partitions by sampled splitters over (leading characters, a hash of the whole text, part), sorted
there outside memory, and every text is compared in full with its neighbours; of equal ones the row with the smallest
(or largest) identifier stays. The splitters see ``LEADING`` characters of a text and its hash, never a whole text, as
Spark samples them to the driver.

A group of copies of any size is no task: one aggregate of text hashes tells which are frequent, and their rows are
dealt to as many parts as they fill, each sorted and compared for itself. One row of each such part, not more than
``MOST_PARTS`` twice over, is compared in full with those of the other parts, and what they found goes back as a list
of bounded size. Whole texts are shuffled once.

A null text counts as empty, and empty texts equal each other. Texts of any length are compared as a whole. A null
identifier loses to every other; of rows that are alike in text and identifier one stays. Other columns are not read,
so their names may clash with those used here. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.shared import settled

#: Characters of a text that splitters see; copies of a text that a part holds at least; parts of all frequent texts.
LEADING, PART_ROWS, MOST_PARTS = 64, 250, 10_000


def groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "smallest",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(id, keep_id, group_size bigint, kept boolean, text_sha256) of every row, dropped ones too.

    ``normalise`` maps a text column to what is compared, by default the text itself.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    whole = F.coalesce(normalise(F.col(text)) if normalise else F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), whole.alias("t")).withColumn("h", F.xxhash64("t"))
    last = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    best = F.max if keep == "largest" else F.min

    # rows of frequent texts are dealt to parts; a part grows with the table, so that the list of them does not
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    per_part = max(part_rows, -(-total // MOST_PARTS))
    frequent = counts.where(F.col("n") > per_part).select("h", F.ceil(F.col("n") / per_part).cast("int").alias("ways"))
    dealt = (
        rows.join(F.broadcast(frequent), "h", "left")
        .withColumn("parts", F.coalesce("ways", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
        .withColumn("leading", F.substring("t", 1, LEADING))
    )
    # both windows and the sort below them use the partitions as they are
    alike = Window.partitionBy("leading", "h", "part", "t")
    sorted_ = alike.orderBy(last)
    first = F.row_number().over(sorted_) == 1
    compared = (
        dealt.repartitionByRange("leading", "h", "part")
        .select(
            "id",
            F.first("id").over(sorted_).alias("keep_id"),
            F.count(F.lit(1)).over(alike).alias("group_size"),
            first.alias("kept"),
            F.sha2("t", 256).alias("text_sha256"),
            F.when(first & (F.col("parts") > 1), F.col("t")).alias("of_parts"),
            (F.col("parts") > 1).alias("in_parts"),
        )
    )
    compared = settled(compared)
    merged = (
        compared.where("of_parts IS NOT NULL")
        .groupBy("of_parts")
        .agg(best("keep_id").alias("all_keep_id"), F.sum("group_size").alias("all_size"), F.first("text_sha256").alias("text_sha256"))
        .select("text_sha256", "all_keep_id", "all_size", F.lit(True).alias("in_parts"))
    )
    both = compared.join(F.broadcast(merged), ["text_sha256", "in_parts"], "left")
    keep_id = F.when(F.col("all_size").isNull(), F.col("keep_id")).otherwise(F.col("all_keep_id"))
    # a part's first row stays if it is the first of all; equal identifiers are in one part
    return both.select(
        "id",
        keep_id.alias("keep_id"),
        F.coalesce("all_size", "group_size").alias("group_size"),
        (F.col("kept") & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )
