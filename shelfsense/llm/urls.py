"""URL verdicts: rules first, then a list of canonical URLs behind a blocked Bloom filter.

A canonical URL is the host without a leading ``www.`` or ``m.`` and the path without slashes at its end; scheme,
query and fragment do not count. A list also holds whole hosts, written with a slash at the end (``host.example/``),
which stand for the host and all its subdomains. The filter is made of blocks of eight 64-bit words; a key sets one bit
in every word of one block. Each distinct URL looks up its own canonical URL and the suffixes of its host; what the
filter passes goes to an exact hash join with the list, so false positives never count. The filter has at most
``MOST_BLOCKS`` blocks of 72 bytes, whatever the length of the list, and so may be broadcast: beyond some four million
keys it passes more, and the join still decides.

A URL that is null or holds no ``://`` has an empty host and path, no rule and no listing. Repeated rows get equal results,
empty tables are empty, and extra columns pass through unless an output column has their name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key, and the most blocks of 512 bits.
KEY_BITS, MOST_BLOCKS = 16, 1 << 17
WORDS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Null where the URL has no host."""
    bare = F.regexp_replace(host(url), r"^(www|m)\.", "")
    return F.when(host(url) != "", F.concat(bare, F.regexp_replace(path(url), r"/+$", "")))


def keys(url: Column) -> Column:
    """What a URL may be listed under: its canonical form, and every suffix of its host as a whole host."""
    labels = F.split(host(url), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.array_join(F.slice(labels, i, F.size(labels)), "."), F.lit("/"))
    )
    return F.when(host(url) != "", F.array_append(suffixes, canonical(url)))


def rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting of ``rules`` (verdict, host, path) as struct<rule, verdict>, else null."""
    found = F.lit(None)
    for verdict, of_host, of_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        found = F.when(fits, F.struct(F.lit(of_host + of_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block")


def _bit(key: str, word: int) -> Column:
    """The bit of a key in a word: six bits of a second hash for each."""
    six = F.shiftrightunsigned(F.xxhash64(F.lit("bit"), key), 6 * word).bitwiseAND(63).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), six)


def bloom(listed: DataFrame, key: str = "key") -> tuple[DataFrame, int]:
    """(block, w0 .. w7) of the filter over ``listed``, and its number of blocks."""
    blocks = max(1, min(MOST_BLOCKS, -(-listed.count() * KEY_BITS // (64 * WORDS))))
    words = [F.bit_or(_bit(key, i)).alias(f"w{i}") for i in range(WORDS)]
    return listed.groupBy(_block(key, blocks)).agg(*words), blocks


def possible(rows: DataFrame, listed: DataFrame, key: str = "key") -> DataFrame:
    """The ``rows`` whose key the filter over ``listed`` passes: all that are listed, and few others."""
    words, blocks = bloom(listed, key)
    met = rows.withColumn("block", _block(key, blocks)).join(F.broadcast(words), "block")
    for i in range(WORDS):
        met = met.where(F.col(f"w{i}").bitwiseAND(_bit(key, i)) != 0)
    return met.select(*rows.columns)


def judge(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url", key: str = "key"
) -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``listed`` (key) are the blocked canonical URLs and hosts."""
    listed = listed.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    pages = pages.drop("host", "path", "rule", "verdict")
    wanted = pages.select(F.col(url).alias("_url")).distinct().select("_url", F.explode(keys(F.col("_url"))).alias("key"))
    blocked = possible(wanted, listed).join(listed, "key").select("_url").distinct().withColumn("_listed", F.lit(True))
    fitting = rule(F.col("host"), F.col("path"), rules)
    return (
        pages.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
        .withColumn("_rule", fitting)
        .join(blocked, F.col(url) == F.col("_url"), "left")
        .withColumn("rule", F.col("_rule.rule"))
        .withColumn(
            "verdict",
            F.coalesce("_rule.verdict", F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))),
        )
        .drop("_rule", "_url", "_listed")
    )
