"""Quality scores by Bradley-Terry ranking.

Labelled texts are paired, one of label 1 with one of label 0; the probability that the first is preferred is
the logistic function of the difference of their scores, and a score is linear in features of the text. Weights
minimise the logistic loss over those feature differences. The score below which the share of label 0 among the
learning rows lies is the threshold; scores are shifted so that it becomes ``CUT`` after squashing to 0..1.

Learning reads at most ``sample`` labelled rows, the smallest by hash of their ids, and scoring is a function
of the text alone, row by row: no shuffle, whatever the size of the table. Null texts are empty, and empty texts have
scores like any other. Labels that are null, neither 0 nor 1, or contradict each other do not count; where only one
label is left all scores are equal. Repeated rows get equal scores; extra columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score of the threshold.
CUT = 0.3
#: Labelled rows to learn from at most, and partners of each row of the rarer label.
SAMPLE, PARTNERS = 20_000, 24
#: Penalty on squared weights, a pair.
PENALTY = 1e-4

_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_STOPS = np.frombuffer(b".,;:'\"?-", np.uint8)
_OTHER = np.frombuffer(b"#$%&*+/<=>@\\^_`~{}[]()", np.uint8)


def features(text: str) -> list[float]:
    """Shares of characters, words and lines of certain kinds, each also saturated so that little is enough."""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [line for line in raw.split(b"\n") if line]
    n, n_words, n_lines = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    letters = max(1, counts[_UPPER].sum() + counts[_LOWER].sum() + counts[128:].sum())
    shares = [
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / n,
        counts[_STOPS].sum() / n,
        counts[_OTHER].sum() / n,
        counts[33] / n_words,  # exclamation marks
        counts[124] / n_words,  # bars
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n_words,
        1 - len(set(lines)) / n_lines if lines else 0.0,
        1 - len(set(words)) / n_words if words else 0.0,
        sum(map(bytes.isupper, words)) / n_words,
    ]
    lengths = [math.log1p(n_words) / 10, len(raw) / n_words / 10, math.log1p(n_words / n_lines) / 5]
    rise = [share / (share + 0.05) for share in shares]
    return [*shares, *rise, *lengths, float(not words), float(n_words < 5)]


N_FEATURES = len(features(""))


@dataclass(frozen=True)
class Ranking:
    """A fitted ranking; ``score`` is a plain function of the text."""

    weights: tuple[float, ...]
    shift: float
    spread: float

    def score(self, text: Column) -> Column:
        weights, shift, spread = np.array(self.weights), self.shift, self.spread

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            raw = np.array([features(t or "") for t in texts]).reshape(-1, N_FEATURES) @ weights
            return pd.Series(1 / (1 + np.exp(-np.clip((raw - shift) / spread + math.log(CUT / (1 - CUT)), -500, 500))))

        return scored(text)


def _fit(x: np.ndarray, label: np.ndarray, partners: int) -> Ranking:
    good, bad = x[label == 1], x[label == 0]
    if not len(good) or not len(bad):
        return Ranking((0.0,) * N_FEATURES, 0.0, 1.0)
    few = min(len(good), len(bad))
    pick = np.random.default_rng(0)
    # every row is in a pair; rows of the rarer label are in several
    n = max(few * partners, len(good), len(bad))
    first = np.concatenate([pick.permutation(len(good)) for _ in range(math.ceil(n / len(good)))])[:n]
    second = np.concatenate([pick.permutation(len(bad)) for _ in range(math.ceil(n / len(bad)))])[:n]
    difference = good[first] - bad[second]
    w = np.zeros(N_FEATURES)
    for _ in range(30):  # Newton's method; the loss is convex
        p = 1 / (1 + np.exp(-np.clip(difference @ w, -500, 500)))
        slope = difference.T @ (p - 1) / n + 2 * PENALTY * w
        bend = (difference * (p * (1 - p))[:, None]).T @ difference / n + 2 * PENALTY * np.eye(N_FEATURES)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    scores = x @ w
    return Ranking(tuple(w.tolist()), float(np.quantile(scores, np.mean(label == 0))), float(max(1.0, scores.std() / 3)))


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, partners: int = PARTNERS
) -> Ranking:
    """Fit on the rows of ``docs`` that ``labels`` (key, label) covers, ``sample`` labelled ids at most."""
    known = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
        .where("_key IS NOT NULL AND _label IN (0, 1)")
        .groupBy("_key")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .where("_label = _other")
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(sample)
        .select("_key", "_label")
    )

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t or "") for t in texts])

    rows = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(known), "_key")  # at most ``sample`` rows
        .select("_key", "_label", measured("_text").alias("_x"))
        .dropDuplicates(["_key", "_x"])
        .orderBy(F.xxhash64("_key"), "_key", "_x")
        .limit(2 * sample)
        .toPandas()
    )
    x = np.array(rows["_x"].tolist()).reshape(-1, N_FEATURES)
    return _fit(x, rows["_label"].to_numpy(), partners)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))
