"""Every registered query on a whole small table, against its SQL where it has one."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shelfsense.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
NATIVE = ("op4_", "op8_", "op13_")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = entry.queries()[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name.startswith(NATIVE):
        assert "Python" not in plan and "Arrow" not in plan
    got = df.toPandas()
    tables = {"op5": "pages", "op9": "pages", "op10": "pages"} | dict.fromkeys(("op6", "op11", "op12"), "embeddings")
    table = tables.get(name.split("_")[0], "documents")
    assert len(got) == spark.read.parquet(f"{DATA}/{table}.parquet").count()
    if name in entry.oracle_sql():
        con = duckdb.connect()
        for t in ("documents", "embeddings", "pages", "labels"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        wanted = con.sql(entry.oracle_sql()[name]).df()
        order = sorted(wanted.columns)
        a, b = (f[order].sort_values(order).reset_index(drop=True) for f in (got, wanted))
        assert a.equals(b)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.count() > 0
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    got = entry.queries()["pipeline"](spark, DATA)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
