"""Document fingerprints by consistent weighted sampling.

The terms of a text are its sequences of ``SHINGLE`` words (a shorter text is one term), weighted by how often they
occur. For every position of a fingerprint, a term k of weight w draws r and c from Gamma(2, 1) and b from [0, 1),
all functions of k and the position alone; with t = floor(ln w / r + b), the smallest c exp(-r (t + 1 - b)) is the
sample. Two texts have the same sample with the probability of their generalised Jaccard similarity, the sum
of the smaller over the sum of the larger weights, so the share of equal positions estimates it. A sample is
identified by its value, of which 32 bits are kept.

Gamma variates are minus the logarithm of a product of two uniforms of 32 hash bits each, so that the far tails, which
decide the least of many terms, are those of the distribution. The two exponential variates whose sum is r also give b:
the share of the first in the sum is uniform and independent of the sum, and stands for 1 - b. So r (1 - b) is the first
of them, and a term of weight one, for which t is 0, has the value c u with one uniform u and a single logarithm. An estimate of likeness J has a standard error of
sqrt(J (1 - J) / SAMPLES), at most 0.088. A text and its edited version share most of their terms, so both are
fingerprinted together: a term is one row with its weight in either, and its draws serve both. Terms are weighed by
sorting within their row and reduced to the samples before anything is shuffled, so neither common terms nor copies
meet. Null texts are empty; texts without words have a fingerprint of zeros, equal to each other. Rows that share an id
are ordered by a hash of their text, wholly repeated rows are one document, and a null id comes last. Extra columns
are not looked at. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.shared import settled

#: Words of a term, samples of a fingerprint.
SHINGLE, SAMPLES = 5, 32
#: What stands for a null id: smaller than all others, so the last by descending id.
NO_ID = -(2**63)
#: Rows that a range of ids holds when documents are put in order, and the most ranges.
RANGE_ROWS, RANGES = 5_000, 20_000
#: An odd number that spreads the numbers of draws over 63 bits.
DRAWS = 0x9E3779B97F4A7C15


#: The Gamma(2, 1) variate of 64 hash bits: the sum of the exponential variates of either half.
GAMMA = (
    "(-ln((CAST({bits} & 4294967295 AS DOUBLE) + 0.5D) * (CAST(shiftrightunsigned({bits}, 32) AS DOUBLE) + 0.5D) * "
    + f"{2.0**-64!r}D))"
)


def _hashed_words(text: Column) -> Column:
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: Column) -> Column:
    """Hashes of all sequences of ``SHINGLE`` words, of all words where they are fewer, none without words."""
    n = F.greatest(F.size(hashes) - (SHINGLE - 1), F.lit(1))
    found = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(SHINGLE))))
    return F.when(F.size(hashes) > 0, found).otherwise(F.array().cast("array<bigint>"))


def weighed_terms(shared: Column, own: Column, other: Column) -> Column:
    """array<struct<term bigint, w0 int, w1 int>>: the distinct terms of two texts with their weight in either.

    The texts are ``shared`` followed by ``own`` and by ``other``; ``shared`` is empty or ends with white space. A term
    within the shared words is made once. The two lowest bits of a hash give way to the text that a term was found in:
    0 for both, 1 and 2 for the first and the second. Sorting brings equal terms together.
    """
    none = F.array().cast("array<bigint>")

    def marked(hashes: Column, mark: int) -> Column:
        return F.transform(hashes, lambda x: x.bitwiseAND(F.lit(-4)).bitwiseOR(F.lit(mark)))

    def of_rest(head: Column, rest: Column) -> Column:
        last = F.slice(head, F.greatest(F.size(head) - (SHINGLE - 2), F.lit(1)), SHINGLE - 1)

        def made(hashes: Column) -> Column:
            done = (F.size(head) >= SHINGLE) & (F.size(hashes) < SHINGLE)
            return F.when(done, none).otherwise(_shingles(hashes))

        return _let(F.concat(last, _hashed_words(rest)), made)

    def all_of(head: Column) -> Column:
        whole = F.when(F.size(head) >= SHINGLE, _shingles(head)).otherwise(none)
        return F.sort_array(F.concat(marked(whole, 0), marked(of_rest(head, own), 1), marked(of_rest(head, other), 2)))

    def runs(codes: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(1), F.size(codes)),
            lambda i: (i == 1) | (F.shiftright(F.get(codes, i - 1), 2) != F.shiftright(F.get(codes, i - 2), 2)),
        )
        return F.when(F.size(codes) > 0, _let(begins, lambda at: F.transform(at, lambda i, j: run(codes, i, F.get(at, j + 1)))))

    def run(codes: Column, begin: Column, following: Column) -> Column:
        code = F.get(codes, begin - 1)
        length = F.coalesce(following, F.size(codes) + 1) - begin
        mark = code.bitwiseAND(F.lit(3))

        def weight(absent: int) -> Column:
            several = F.size(F.filter(F.slice(codes, begin, length), lambda x: x.bitwiseAND(F.lit(3)) != absent))
            return F.when(length == 1, (mark != absent).cast("int")).otherwise(several)

        return F.struct(code.bitwiseAND(F.lit(-4)).alias("term"), weight(2).alias("w0"), weight(1).alias("w1"))

    return _let(_let(_hashed_words(shared), all_of), runs)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _samples(positions: int) -> list[Column]:
    """The least sample of the rows (term, weight) for every position; null without terms."""
    found = []
    for position in range(positions):
        bits = [f"xxhash64(term ^ {(2 * position + i + 1) * DRAWS % 2**63})" for i in range(2)]
        u, v = (f"((CAST({x} AS DOUBLE) + 0.5D) * {2.0**-32!r}D)" for x in (f"{bits[0]} & 4294967295", f"shiftrightunsigned({bits[0]}, 32)"))
        c, minus_r = GAMMA.format(bits=bits[1]), f"ln({u} * {v})"
        t = f"floor(1.0D - (ln(CAST(weight AS DOUBLE)) + ln({u})) / {minus_r})"
        scale = f"CASE WHEN weight > 1 THEN exp({minus_r} * {t}) ELSE 1.0D END"
        found.append(F.expr(f"min({c} * {u} * {scale})").alias(f"s{position}"))
    return found


def fingerprints(
    texts: DataFrame, keys: list[str], shared: str, own: str, other: str, positions: int = SAMPLES
) -> DataFrame:
    """(keys..., signature, other_signature array<int>): one row for each distinct value of ``keys``, whose rows share
    their texts: ``shared`` followed by ``own``, and ``shared`` followed by ``other``.

    A term that weighs the same in both texts, as most do, is sampled once for both. Where ``texts`` is partitioned by
    some of ``keys``, nothing is shuffled.
    """
    weighed = texts.select(*keys, F.inline_outer(weighed_terms(F.col(shared), F.col(own), F.col(other))))
    of_both = F.array(F.struct(F.lit(0).alias("of"), F.col("w0").alias("weight")))
    of_each = F.array(*(F.struct(F.lit(i + 1).alias("of"), F.col(f"w{i}").alias("weight")) for i in (0, 1)))
    rows = weighed.select(*keys, "term", F.inline(F.when(F.col("w0") == F.col("w1"), of_both).otherwise(of_each)))
    sampled = rows.where("weight > 0 OR term IS NULL").groupBy(*keys, "of").agg(*_samples(positions))
    least = sampled.groupBy(*keys).agg(
        *(F.min(F.when(F.col("of") != 2 - i, F.col(f"s{p}"))).alias(f"s{i}_{p}") for i in (0, 1) for p in range(positions))
    )

    def signature(i: int) -> Column:
        kept = [F.coalesce(F.hash(f"s{i}_{p}"), F.lit(0)) for p in range(positions)]
        return F.when(F.col(f"s{i}_0").isNull(), F.array_repeat(F.lit(0), positions)).otherwise(F.array(*kept))

    return least.select(*keys, signature(0).alias("signature"), signature(1).alias("other_signature"))


def likeness(one: Column, other: Column) -> Column:
    """The share of equal positions."""
    same = F.filter(F.zip_with(one, other, lambda a, b: a == b), lambda x: x)
    return F.size(same) / F.size(one).cast("double")


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x.cast("bigint").bitwiseAND(2**32 - 1)), 8, "0")), "")


def succession(keys: DataFrame) -> DataFrame:
    """``keys`` (id, tie, ...) with next_id, next_tie: the next row by descending id, after the last the first.

    Rows are dealt to ranges of ids, so no task sorts them all; only the first row of each range is put in one order.
    """
    ranges = max(1, min(RANGES, math.ceil(keys.count() / RANGE_ROWS)))
    order = [F.col("id").desc(), F.col("tie")]
    ranged = settled(keys.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range").orderBy(*order)
    heads = ranged.withColumn("at", F.row_number().over(inside)).where("at = 1").select("range", "id", "tie")
    by_range = Window.orderBy("range")
    head = F.struct("id", "tie")
    all_heads = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = heads.select(
        "range", F.coalesce(F.lead(head).over(by_range), F.first(head).over(all_heads)).alias("head")
    )
    led = ranged.withColumn("next", F.lead(head).over(inside)).join(follows, "range")
    after = F.coalesce("next", "head")
    return led.select(*keys.columns, after["id"].alias("next_id"), after["tie"].alias("next_tie"))


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, tie, copies, shared, own, other), a row a document, and (id, tie, copies, n_chars, next_id, next_tie), distinct.

    The text is ``shared`` followed by ``own``, its edited version ``shared`` followed by ``other``: the last third of
    the text is replaced by as much of the front of the next document by descending id, and what both begin with is
    cut behind white space, so that no word lies across.
    Texts are shuffled once, by their key. Every document then hands the piece of its front that is asked for to the
    one before it, and what it keeps stays where it is. ``id`` is ``NO_ID`` where it was null.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64(whole).alias("tie"), whole.alias("text")
    )
    keys = rows.groupBy("id", "tie").agg(F.count(F.lit(1)).alias("copies"), F.max(F.length("text")).alias("n_chars"))
    order = settled(succession(settled(keys)))
    asked = order.select(
        F.col("next_id").alias("id"),
        F.col("next_tie").alias("tie"),
        F.col("id").alias("for_id"),
        F.col("tie").alias("for_tie"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("third"),
    )
    met = rows.join(order.join(asked, ["id", "tie"]), ["id", "tie"])
    fronts = (
        met.select("for_id", "for_tie", F.substring(F.col("text"), F.lit(1), F.col("third")).alias("front"))
        .groupBy(F.col("for_id").alias("id"), F.col("for_tie").alias("tie"))
        .agg(F.any_value("front").alias("front"))
    )
    n_stays = F.col("n_chars") - F.floor(F.col("n_chars") / 3).cast("int")
    stays = F.substring(F.col("text"), F.lit(1), n_stays)
    shared = F.regexp_extract(F.col("stays"), r"(?s)^.*[\x20\x09-\x0D]", 0)
    begun = F.substring(F.col("stays"), F.length("shared") + 1, F.col("n_chars"))
    texts = (
        met.drop("for_id", "for_tie", "third")
        .join(fronts, ["id", "tie"])
        .withColumn("stays", stays)
        .withColumn("shared", shared)
        .withColumn("own", F.substring(F.col("text"), F.length("shared") + 1, F.col("n_chars")))
        .withColumn("other", F.concat(begun, "front"))
        .select("id", "tie", "copies", "shared", "own", "other")
    )
    return texts, order


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text", positions: int = SAMPLES) -> DataFrame:
    """One row a row of ``docs``: (id, n_chars, edited_sha256, signature, edited_signature, near_edited, near_next)."""
    both, order = edited(docs, key, text)
    digest = F.unhex(F.sha2(F.concat("shared", "other"), 256)).alias("digest")
    rows = both.select("id", "tie", digest, "shared", "own", "other")
    prints = fingerprints(rows, ["id", "tie", "digest"], "shared", "own", "other", positions)
    paired = settled(
        order.join(prints, ["id", "tie"])
        .withColumn("edited_sha256", F.lower(F.hex("digest")))
        .withColumnRenamed("other_signature", "edited_signature")
        .drop("digest")
    )
    following = paired.select(
        F.col("id").alias("next_id"), F.col("tie").alias("next_tie"), F.col("signature").alias("next_signature")
    )
    return (
        paired.join(following, ["next_id", "next_tie"])
        .select(
            F.when(F.col("id") != NO_ID, F.col("id")).alias("id"),
            F.col("n_chars").cast("bigint").alias("n_chars"),
            "edited_sha256",
            "signature",
            "edited_signature",
            likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
            likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
        )
        .drop("_copy")
    )
