import pytest
from pyspark.sql import functions as F

from shelfsense import schemas as S
from shelfsense.shared import run_dir
from shelfsense.sources import text
from shelfsense.sources.catalog import Catalog

GOOD = '12^ A "name", x \t^1,2,3^B00^ img/1,2%20.jpg ^ a|b|c ^red|Blue'


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_product_line(spark):
    row = text.products_from_lines(lines(spark, GOOD)).first()
    assert row.asDict() == {
        "productId": 12,
        "name": 'A "name", x',
        "categories": "a|b|c",
        "imageUrl": "img/1,2%20.jpg",
        "tags": "red|Blue",
    }


def test_trailing_separator_means_empty_tags(spark):
    assert text.products_from_lines(lines(spark, "1^n^1^c^i^k^")).first().tags == ""


@pytest.mark.parametrize("bad", ["1^n^1^c^i^k", "x^n^1^c^i^k^t", ""])
def test_malformed_product_line(spark, bad):
    with pytest.raises(Exception, match="fewer than 7|not a valid"):
        text.products_from_lines(lines(spark, GOOD, bad)).collect()
    accepted, rejected = text.split_product_lines(lines(spark, GOOD, bad))
    assert [r.productId for r in accepted.collect()] == [12]
    assert [r.value for r in rejected.collect()] == [bad]


def test_rating_lines(spark):
    rows = text.ratings_from_lines(lines(spark, "-5,12,4.5,1260759144", "5,12,3,1260759144999")).collect()
    assert [tuple(r) for r in rows] == [(-5, 12, 4.5, 1260759144), (5, 12, 3.0, 1260759144999)]


@pytest.mark.parametrize("bad", ["5,12,4.5", "5,12,high,1", "a,12,4.5,1"])
def test_malformed_rating_line(spark, bad):
    with pytest.raises(Exception, match="fewer than 4|not a valid"):
        text.ratings_from_lines(lines(spark, bad)).collect()
    accepted, rejected = text.split_rating_lines(lines(spark, "5,12,4.5,9", bad))
    assert accepted.count() == 1 and [r.value for r in rejected.collect()] == [bad]


def test_log_lines(spark):
    rows = text.ratings_from_log(
        lines(
            spark,
            "2024-02-01 10:00:00,000   INFO --- [main] api  :  PRODUCT_RATING_PREFIX:-7|12|4.5|1260759144",
            "java.lang.IllegalStateException: PRODUCT_RATING_PREFIX",
            "\tat some.Class(Line:1)",
            "PRODUCT_RATING_PREFIX:7|12|4.5",
            "PRODUCT_RATING_PREFIX:7|12|4.5.1|5",
            "",
        )
    ).collect()
    assert [tuple(r) for r in rows] == [(-7, 12, 4.5, 1260759144)]


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_collections(spark, ratings_of, fmt):
    catalog = Catalog(spark, run_dir(spark, "test"), fmt)
    first, second = ratings_of([(1, 2, 3.0, 4)]), ratings_of([(5, 6, 7.0, 8)])
    catalog.overwrite(S.RATING_COLLECTION, second)
    catalog.overwrite(S.RATING_COLLECTION, first)
    assert [tuple(r) for r in catalog.read(S.RATING_COLLECTION).collect()] == [(1, 2, 3.0, 4)]
    catalog.append(S.RATING_COLLECTION, second)
    assert catalog.read(S.RATING_COLLECTION).schema == S.RATING
    catalog.view(S.RATING_COLLECTION, "rating_view")
    assert sorted(tuple(r) for r in spark.sql("SELECT * FROM rating_view").collect()) == [
        (1, 2, 3.0, 4),
        (5, 6, 7.0, 8),
    ]


def test_a_lost_write_leaves_the_collection(spark, ratings_of):
    """A job that dies while it writes, and one that dies before the pointer moves, are as if they had not been."""
    catalog = Catalog(spark, run_dir(spark, "test"))
    catalog.overwrite(S.RATING_COLLECTION, ratings_of([(1, 2, 3.0, 4)]))
    open_reader = catalog.read(S.RATING_COLLECTION)
    failing = ratings_of([(5, 6, 7.0, 8)]).withColumn("ts", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        catalog.overwrite(S.RATING_COLLECTION, failing)
    catalog._written(S.RATING_COLLECTION, ratings_of([(9, 9, 9.0, 9)]))
    assert [tuple(r) for r in catalog.read(S.RATING_COLLECTION).collect()] == [(1, 2, 3.0, 4)]
    # a reader goes on with what it has begun to read, until vacuum
    catalog.overwrite(S.RATING_COLLECTION, catalog.read(S.RATING_COLLECTION).union(ratings_of([(5, 6, 7.0, 8)])))
    assert [tuple(r) for r in open_reader.collect()] == [(1, 2, 3.0, 4)]
    catalog.vacuum(S.RATING_COLLECTION)
    assert len(catalog.snapshots(S.RATING_COLLECTION)) == 1
    assert sorted(tuple(r) for r in catalog.read(S.RATING_COLLECTION).collect()) == [(1, 2, 3.0, 4), (5, 6, 7.0, 8)]
