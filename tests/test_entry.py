import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from shelfsense.operators import corating
from shelfsense.plans import bindings

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages labels"
# the training-data operators, where they are there, have tests of their own
OWN = sorted(n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    got = rows_of(df.toPandas())
    assert len(got)
    if name in entry.oracle_sql():
        wanted = rows_of(duck.sql(entry.oracle_sql()[name]).df())
        assert list(got.columns) == list(wanted.columns)
        assert [str(t) for t in got.dtypes] == [str(t) for t in wanted.dtypes]
        assert got.equals(wanted)


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "rid"


def test_only_needed_columns_and_rows_are_read(spark):
    def plan(name):
        return entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()

    counts = plan("rate_more")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in counts
    assert "ReadSchema: struct<o_orderkey:bigint" in counts and "o_totalprice" not in counts
    assert "EqualTo(p_partkey,42)" in plan("product_by_id")
    assert "EqualTo(event_type,purchase)" in plan("rating_lookup")
    # the co-rating queries store what they have read before they are planned on
    incidence = corating._incidence(bindings.event_ratings(spark, DATA), True)
    assert "ReadSchema: struct<user_id:bigint,props:string>" in incidence._jdf.queryExecution().executedPlan().toString()


def test_no_more_shuffles_than_needed(spark):
    def shuffles(name):
        plan = entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    for name in ("rate_more", "rate_more_recently", "recent_ratings_40", "first_rating"):
        assert shuffles(name) == 1, name
