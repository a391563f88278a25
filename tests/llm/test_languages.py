import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.llm import languages
from shelfsense.llm.queries import document_number, held_out_number

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "pages")]


@pytest.fixture(scope="module")
def evidence(tables):
    docs, pages = tables
    number = document_number(F.col("url"))
    return languages.learn(docs.where(~held_out_number(F.col("doc_id"))), pages, number, sample=3000)


def test_held_out_accuracy(tables, evidence):
    docs, pages = tables
    found = languages.identify(pages, evidence)
    wanted = pages.select(F.col("page_id").alias("id"), document_number(F.col("url")).alias("doc_id")).join(
        docs.select("doc_id", F.col("lang").alias("wanted")), "doc_id"
    )
    rows = found.join(wanted, "id").where(held_out_number(F.col("doc_id"))).toPandas()
    assert len(rows) > 200 and (rows.lang == rows.wanted).mean() > 0.97
    assert np.allclose(np.array(rows.posterior.tolist()).sum(1), 1)


def test_each_kind_of_evidence_counts(spark, evidence):
    text = "<html><body><p>die und der eine ist nicht schach ung keit</p></body></html>"
    rows = [
        (1, "http://h.zz/a", text),
        (2, "http://h.zz/a", '<html lang="fr-CA"><body></body></html>'),
        (3, "http://x.example.net/es/1", None),
        (4, None, None),
        (4, None, None),
        (5, "http://only.de.example/", '<HTML LANG=de>' + "é" * 200_000),
        (None, "http://many.example/", "<p>1 2 3</p>"),
    ]
    rows += [(100 + i, "http://many.example/x", text) for i in range(60)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, lang string")
    got = {r.id: r for r in languages.identify(pages, evidence).collect()}
    assert len(got) == len(rows) - 1
    assert (got[1].lang, got[2].lang, got[3].lang) == ("de", "fr", "es")
    assert got[None].lang == "de"  # by its host alone
    assert all(0 < r.score <= 1 for r in got.values())
    assert languages.identify(pages.limit(0), evidence).collect() == []


def test_priors_by_hand(spark, evidence):
    """Host, domain and overall shares, each without the page's own."""
    words = {"de": "und der die nicht eine schach", "fr": "que les une est dans pour"}
    rows = [(i, f"http://{h}.d{i % 2}.org/", f"<p>{words[x]}</p>") for i, (h, x) in enumerate([("a", "de"), ("b", "fr"), ("a", "de"), ("a", "fr"), ("c", "de")] * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.id: r.posterior for r in languages.identify(pages, evidence).collect()}
    k, s = len(evidence.languages), languages.STRENGTH
    likely = []
    for _, _, page in rows:
        x = evidence.text[:, languages._buckets(languages.visible(page))].sum(1) * languages.TEMPER
        likely.append(x + np.array(evidence.suffix.get("org/", [0.0] * k)))
    first = [np.exp(x - x.max()) / np.exp(x - x.max()).sum() for x in likely]
    base = (sum(first) + 1) / (len(rows) + k)
    for i, (_, url, _) in enumerate(rows):
        host = url[7:-1]
        same = [first[j] for j in range(len(rows)) if rows[j][1] == url]
        near = [first[j] for j in range(len(rows)) if rows[j][1][7:-1].split(".")[-2:] == host.split(".")[-2:]]
        top = (sum(near) - first[i] + s * base) / (len(near) - 1 + s)
        prior = (sum(same) - first[i] + s * top) / (len(same) - 1 + s)
        post = np.exp(likely[i] - likely[i].max()) * prior
        assert got[i] == pytest.approx((post / post.sum()).tolist(), rel=1e-6, abs=1e-12)
