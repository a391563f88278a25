import pytest
from pyspark.sql import functions as F

from shelfsense.operators import patterns

PATTERNS = {
    "red ring": {"red", "ed ", "d r", " ri", "rin", "ing"},
    "^ring$": {"rin", "ing"},
    "ab": set(),
    "": set(),
    "colou?red": {"col", "olo", "red"},
    "abc+def": {"abc", "def"},
    "abcd*e": {"abc"},
    "abcd{0,2}efg": {"abc", "efg"},
    "abc??def": {"def"},
    "red|ring": set(),
    "ring(red|blue)bolt": {"rin", "ing", "bol", "olt"},
    "((bolt)?ring)*red": {"red"},
    "(?:bolt)ring": {"rin", "ing"},
    "(?i)ring": set(),
    "(?i:bolt)ring": set(),
    "[abc]ring[^]x]": set(),
    "ring[x-z]red": {"rin", "ing", "red"},
    r"\Qring\E": set(),
    r"ring\dred": {"rin", "ing", "red"},
    r"\x72ing": set(),
    r"ring\.red": {"rin", "ing", "red"},
    r"ring\\Qred": set(),
    "r.ng": set(),
    "größe": {"grö", "röß", "öße"},
}


def test_pieces_that_every_match_holds(spark):
    table = spark.createDataFrame([(p,) for p in PATTERNS], "p string")
    got = {r.p: set(r.q) for r in table.select("p", patterns.required_pieces(F.col("p")).alias("q")).collect()}
    assert got == PATTERNS


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_equals_trying_every_pattern(spark, block):
    names = [
        "red ring", "Ring", "ring", "ab", "", None, "colored", "coloured", "abccdef", "abce", "abcddefg", "abdef", "blue",
        "ringbluebolt", "boltringred", "boltring", "BOLTring", "aringy", "ringyred", "ring7red", "ring.red", r"ring\Qred",
        "rung", "größe", "Qring",
    ]
    # a third of the rows hold the same piece, and a row may be there twice
    rows = [(i, n) for i, n in enumerate(names)] + [(100 + i % 40, "one ring") for i in range(60)]
    texts = spark.createDataFrame(rows, "id bigint, name string")
    table = spark.createDataFrame([(p,) for p in [*PATTERNS, "ring", None, "xyzzy", "(r)(i)(n)(g)"] * 2], "pattern string")
    got = patterns.matches(texts, "name", table, block)
    wanted = [
        (p, r.id, r.name)
        for p in [*PATTERNS, "ring", "xyzzy", "(r)(i)(n)(g)"] if p != "ring"
        for r in texts.where(F.col("name").rlike(p)).collect()
    ] + [("ring", r.id, r.name) for r in texts.where("name LIKE '%ring%'").collect()]
    assert got.columns == ["pattern", "id", "name"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(wanted)


def test_only_rows_with_a_rare_piece_are_tried(spark):
    texts = spark.range(3000).select(F.concat(F.lit("item number "), F.col("id").cast("string"), F.lit(" of many")).alias("name"))
    table = spark.range(1000, 1300).select(F.concat(F.lit("number "), F.col("id").cast("string"), F.lit(" of")).alias("pattern"))
    rows = patterns.rarest_pieces(texts, "name", table).agg(F.sum("_rows"), F.count(F.lit(1))).first()
    assert rows[1] == 300 and rows[0] < 300 * 3000 / 20


def test_empty_tables(spark):
    texts = spark.createDataFrame([("ring",)], "name string")
    table = spark.createDataFrame([("ring",), ("r.g",)], "pattern string")
    assert patterns.matches(texts.limit(0), "name", table).count() == 0
    assert patterns.matches(texts, "name", table.limit(0)).count() == 0
