import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.llm import weighted_sampling as ws


def weights(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def jaccard(a, b):
    a, b = weights(a), weights(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def gamma_quantiles(n):
    """Quantiles (i + 1/2) / n of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x)."""
    found = []
    for i in range(n):
        wanted, low, high = (i + 0.5) / n, 0.0, 64.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if 1 - (1 + middle) * math.exp(-middle) < wanted else (low, middle)
        found.append(low)
    return found


def prints_of(spark, pairs, positions=ws.SAMPLES):
    """{n: (signature, other signature)} of pairs of texts, cut at their common words."""
    rows = []
    for n, (a, b) in enumerate(pairs):
        upto = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        upto = a.rfind(" ", 0, upto) + 1
        rows.append((n, a[:upto], a[upto:], b[upto:]))
    frame = spark.createDataFrame(rows, "n long, shared string, own string, other string")
    got = ws.fingerprints(frame, ["n"], "shared", "own", "other", positions).collect()
    return {r.n: (np.array(r.signature), np.array(r.other_signature)) for r in got}


def test_weights_of_two_texts(spark):
    """Terms and both weights against counting, wherever the texts are cut."""
    pick, rows = random.Random(5), []
    for n in range(200):
        words = [pick.choice("abc") for _ in range(pick.randrange(14))]
        head = "".join(w + pick.choice([" ", "\n ", "\t"]) for w in words[: pick.randrange(len(words) + 1)])
        own, other = (" ".join(pick.choice("abc") for _ in range(pick.randrange(9))) for _ in range(2))
        rows.append((n, head, own, other))
    rows += [(900, "", "", ""), (901, "a ", "", "b"), (902, "a b c d ", "", "e"), (903, "a b c d e ", "", "e"), (904, " ", "x", "")]
    frame = spark.createDataFrame(rows, "n long, shared string, own string, other string")
    got = frame.select("n", F.inline(ws.weighed_terms(F.col("shared"), F.col("own"), F.col("other")))).collect()
    found = {n: (Counter(), Counter()) for n, *_ in rows}
    for r in got:
        assert r.term not in found[r.n][0]
        found[r.n][0][r.term] += r.w0
        found[r.n][1][r.term] += r.w1
    for n, head, own, other in rows:
        a, b = weights(head + own), weights(head + other)
        joint = sorted((a[t], b[t]) for t in a.keys() | b.keys())
        one, two = found[n]
        assert sorted((one[t], two[t]) for t in one.keys() | two.keys()) == joint, (head, own, other)


def test_quantiles():
    levels = np.array(gamma_quantiles(1000))
    assert levels.mean() == pytest.approx(2, abs=0.01) and levels.var() == pytest.approx(2, abs=0.05)


def test_variates_keep_their_tails(spark):
    bits = spark.range(0, 1_000_000, 1, 8).select(F.xxhash64("id").alias("bits"))
    x = np.sort(bits.select(F.expr(ws.GAMMA.format(bits="bits")).alias("x")).toPandas()["x"].to_numpy())
    assert np.abs(x[500::1000] - gamma_quantiles(1000)).max() < 0.5 and x.mean() == pytest.approx(2, abs=0.01)
    for far in (1e-2, 3e-3):
        assert (x < far).mean() == pytest.approx(far**2 / 2, rel=0.3 if far == 1e-2 else 1)
    assert x[0] < 5e-3 and x[-1] > 13  # 2^10 quantiles reach from 0.03 to 10


def test_light_terms_of_long_texts_win_their_share(spark):
    # n light terms against one term of weight n: either holds the least sample at half of the positions
    n, positions = 30_000, 128
    light = spark.range(n).select(F.xxhash64("id").alias("term"), F.lit(1).alias("weight"))
    heavy = spark.range(1).select(F.lit(-1).alias("term"), F.lit(n).alias("weight"))
    won = 0
    for salt in range(3):
        salted = [d.select(F.xxhash64("term", F.lit(salt)).alias("term"), "weight") for d in (light, heavy)]
        one, other = (d.agg(*ws._samples(positions)).first() for d in salted)
        won += sum(a < b for a, b in zip(one, other, strict=True))
    assert abs(won / (3 * positions) - 0.5) < 4 * (0.25 / (3 * positions)) ** 0.5


def test_error_of_the_samples_of_production(spark):
    pick, pairs = random.Random(3), []
    for i in range(300):
        share = (0.3, 0.5, 0.7, 0.9)[i % 4]
        a = [f"w{pick.randrange(10**6)}" for _ in range(200)]
        pairs.append((" ".join(a), " ".join(a[: int(share * 200)] + [f"v{pick.randrange(10**6)}" for _ in range(200 - int(share * 200))])))
    got = prints_of(spark, pairs)
    true = np.array([jaccard(*p) for p in pairs])
    errors = np.array([np.mean(got[i][0] == got[i][1]) for i in range(len(pairs))]) - true
    scaled = errors / np.sqrt(true * (1 - true) / ws.SAMPLES)
    assert len(got[0][0]) == ws.SAMPLES and np.abs(scaled).max() < 4.5
    assert abs(scaled.mean()) < 0.25 and 0.85 < scaled.std() < 1.15


def test_collisions_follow_generalised_jaccard(spark):
    pick, pairs = random.Random(0), []
    for share in (0.1, 0.3, 0.5, 0.7, 0.9):
        for _ in range(12):
            a = pick.choices("abcdefghij", k=300)
            b = [w if i < share * 300 else pick.choice("klmnop") for i, w in enumerate(a)]
            repeat = ["q"] * pick.choice([0, 60, 200])  # one heavy term
            pairs.append((" ".join(a + repeat), " ".join(b + repeat[: pick.choice([30, 200])])))
    got = prints_of(spark, pairs, 128)
    errors = [np.mean(got[i][0] == got[i][1]) - jaccard(*p) for i, p in enumerate(pairs)]
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.18


@pytest.mark.parametrize("range_rows", [5000, 3])
def test_edited_texts_and_order(spark, monkeypatch, range_rows):
    monkeypatch.setattr(ws, "RANGE_ROWS", range_rows)
    pick = random.Random(1)
    docs = {i * 7 % 101: " ".join(pick.choices(["añb", "🙂", "c", "dd"], k=pick.randrange(60))) for i in range(40)}
    docs |= {500: None, 501: "", 502: " \n ", 503: "one", 504: "x " * 9000}
    frame = spark.createDataFrame([(i, t, "?") for i, t in docs.items()], "doc_id long, text string, signature string")
    got = {r.id: r for r in ws.compared(frame).collect()}
    assert len(got) == len(docs)
    order = sorted(docs, reverse=True)
    for i, following in zip(order, order[1:] + order[:1], strict=True):
        text, after = docs[i] or "", docs[following] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(got[i].near_edited - jaccard(text, changed)) < 0.45 or not weights(text)
        if weights(text) == weights(after):
            assert got[i].near_next == 1
        assert len(ws.as_text and got[i].signature) == ws.SAMPLES
    plan = ws.compared(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ties_nulls_repeats(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h"), (None, "a b c d e f"), (None, None), (None, None)]
    got = ws.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6
    assert len({tuple(r.signature) for r in got if r.n_chars == 11}) == 1
    assert ws.compared(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    one = ws.compared(spark.createDataFrame([(1, "abc def")], "doc_id long, text string")).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()
