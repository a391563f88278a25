"""Stages of the pipeline on odd tables."""

import pytest

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


def test_passages_with_clashing_columns(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(1, f"one {passage} end", "a", "s"), (2, f"two {passage} other", "b", "s"), (3, None, "c", "s"), (4, "", "d", "s")]
    rows += [(5, passage, "e", "s"), (6, "x " * 200_000, "f", None), (7, "own words here", None, None)]
    docs = spark.createDataFrame(
        [(*r, len(r[1] or ""), 5, "kept?", 9, True) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, bucket int, kept string, n_words long, n_removed boolean",
    )
    got = {r.doc_id: r for r in corpus_pipeline.without_repeats(spark, docs, DATA).collect()}
    # the fifth loses all its words and goes, of the sixth only the first word is in no repeated window
    assert set(got) == {1, 2, 3, 4, 6, 7}
    assert got[1].text == rows[0][1] and got[2].text == "two other" and got[2].n_chars == 9
    assert got[3].text is None and got[4].text == "" and got[6].text == "x"
    assert all((r.bucket, r.kept, r.n_words, r.n_removed) == (5, "kept?", 9, True) for r in got.values())


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_empty_tables(spark, number):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    name, stage = corpus_pipeline.STAGES[number]
    assert stage(spark, docs.limit(0), DATA).count() == 0, name
