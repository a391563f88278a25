import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.llm import quality

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels.where(~quality.held_out()))
    rows = docs.join(labels, "doc_id").select("doc_id", "quality", quality.held_out().alias("out"), model.score(F.col("text")).alias("s")).toPandas()
    assert all(o == (zlib.crc32(str(i).encode()) % 5 == 0) for i, o in zip(rows.doc_id, rows.out, strict=True))
    out = rows[rows.out]
    good, bad = out[out.quality == 1].s.to_numpy(), out[out.quality == 0].s.to_numpy()
    assert np.mean(good[:, None] > bad[None, :]) > 0.97
    assert ((out.s >= quality.CUT) == (out.quality == 1)).mean() > 0.95


def test_gradient_vanishes_at_the_fit():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(200, quality.N_FEATURES))
    label = (x[:, 0] + 0.5 * pick.normal(size=200) > 0.8).astype(int)
    ranking = quality._fit(x, label, 5)
    scores = x @ np.array(ranking.weights)
    assert np.mean(scores[label == 1][:, None] > scores[label == 0][None, :]) > 0.9
    assert np.mean(scores < ranking.shift) == pytest.approx(np.mean(label == 0), abs=0.02)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good words here", 5), (2, None, 5), (2, None, 5), (None, "", 6), (4, "!!! $$$ %%%", 7), (5, "x " * 50_000, 8)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (2, None), (5, 0), (5, 1), (None, 1), (9, 7)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = docs.withColumn("s", model.score(F.col("text"))).collect()
    assert len(got) == 6 and all(0 <= r.s <= 1 for r in got)
    by = {r.doc_id: r.s for r in got}
    assert by[1] > by[4] and by[2] == by[None]
    for few in (labels.limit(0), labels.where("quality = 1")):
        alone = quality.learn(docs, few)
        assert len({r.s for r in docs.select(alone.score(F.col("text")).alias("s")).collect()}) == 1
    assert docs.limit(0).select(model.score(F.col("text"))).collect() == []
