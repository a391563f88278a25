"""Language of pages by fusing evidence.

By Bayes' rule, the odds of a language are those of its prior at the page's host, times the likelihoods of the text, of the
language that the markup declares, and of the suffix of the address (the last label of the host with the first
part of the path). Text likelihoods come from counts of hashed sequences of three bytes; likelihoods of declarations and
suffixes from counts on labelled pages, smoothed with one count for any value not seen.

A host's prior is smoothed by that of its domain (the last two labels), and that by the prior over all pages: each
level adds ``STRENGTH`` pages that follow the level above. The counts are sums of the posteriors without host, by grouped
aggregation over all pages, less the page's own, so that no page is its own evidence. A host that holds any share of the
pages is summed before the shuffle, and reaches its pages by a plain join.

Likelihoods are learnt from at most ``SAMPLE`` labelled rows each, all else covers every page. Null pages and URLs are
empty evidence: without any, the answer is the prior over all pages. Repeated rows get nearly equal results (each is one
page of the counts); empty tables are empty; other columns are not looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.llm import urls
from shelfsense.shared import settled

#: Labelled documents and pages to learn from at most; hash buckets; pages that a level of the prior adds.
SAMPLE, BUCKETS, STRENGTH = 20_000, 1 << 14, 5.0
#: What one sequence counts against the other evidence: neighbouring ones overlap, so they speak alike.
TEMPER = 1 / 3

_MARKUP = re.compile(r"<script\b.*?(?:</script|\Z)|<style\b.*?(?:</style|\Z)|<!--.*?(?:-->|\Z)|<[^>]*+(?:>|\Z)", re.S | re.I)


def _buckets(text: str) -> np.ndarray:
    """Hash buckets of all sequences of three bytes of the lower-cased words."""
    raw = np.frombuffer(f" {' '.join(text.lower().split())} ".encode(), np.uint8).astype(np.uint32)
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:] if len(raw) > 2 else raw[:0]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def visible(page: str) -> str:
    return html.unescape(_MARKUP.sub(" ", page))


def declared(page: Column) -> Column:
    """The first two letters of the language the markup declares, lower case; '' if none."""
    found = F.regexp_extract(page, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2})", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def suffix(url: Column) -> Column:
    """The last label of the host and the first part of the path, when that has two letters: ``net/fr``."""
    label = F.element_at(F.split(urls.host(url), r"\."), -1)
    part = F.regexp_extract(urls.path(url), r"^/([a-zA-Z]{2})(?:/|$)", 1)
    return F.concat(label, F.lit("/"), F.lower(part))


def domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


@dataclass(frozen=True)
class Evidence:
    """Languages, and logarithms of likelihoods: (bucket, language), and value -> one for each language."""

    languages: tuple[str, ...]
    text: np.ndarray
    declared: dict[str, list[float]]
    suffix: dict[str, list[float]]


def _text_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (language, text) -> (language, counts of the buckets)."""
    for batch in batches:
        counts: dict[str, np.ndarray] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = counts.setdefault(language, np.zeros(BUCKETS, np.int64))
            own += np.bincount(_buckets(text or ""), minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c.tobytes() for c in counts.values()], pa.binary())],
            ["language", "counts"],
        )


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table["counts"].to_pylist())
    return pa.table({"language": table["language"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _sampled(rows: DataFrame, key: str, sample: int) -> DataFrame:
    """All rows up to ``sample``, else about that many, by hash of their key."""
    n = rows.count()
    return rows if n <= sample else rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * sample / n))


def learn(docs: DataFrame, pages: DataFrame, number: Column, sample: int = SAMPLE) -> Evidence:
    """From ``docs`` (doc_id, text, lang), and from ``pages`` (url, html) whose document ``number`` names."""
    known = _sampled(docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", "text"), "doc_id", sample)
    summed = (
        known.select("lang", "text")
        .mapInArrow(_text_counts, "language string, counts binary")
        .groupBy("language")
        .applyInArrow(_added, "language string, counts binary")
        .collect()
    )
    by_language = {r.language: np.frombuffer(r.counts, np.int64) for r in summed}
    languages = tuple(sorted(by_language))
    index = {language: i for i, language in enumerate(languages)}
    text = np.array([np.log((by_language[x] + 0.5) / (by_language[x].sum() + 0.5 * BUCKETS)) for x in languages])

    labels = docs.where("lang IS NOT NULL").select(F.col("doc_id").alias("_doc"), "lang").distinct()
    labelled = _sampled(pages.select(number.alias("_doc"), "url", "html").where("_doc IS NOT NULL"), "_doc", sample)
    values = F.explode(
        F.array(
            F.struct(F.lit("declared").alias("kind"), declared(F.col("html")).alias("value")),
            F.struct(F.lit("suffix").alias("kind"), F.coalesce(suffix(F.col("url")), F.lit("")).alias("value")),
        )
    )
    pairs = labelled.select("_doc", values.alias("e")).join(labels, "_doc").groupBy("e.kind", "e.value", "lang")
    found: dict[str, dict[str, list[float]]] = {"declared": {}, "suffix": {}}
    for r in pairs.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind", "value", "lang").limit(20_000).collect():
        if r.lang in index:
            found[r.kind].setdefault(r.value, [0.0] * len(languages))[index[r.lang]] += r.n
    likely = {}
    for kind, table in found.items():
        total = [sum(row[i] for row in table.values()) for i in range(len(languages))]
        spread = len(table) + 1
        smooth = [[math.log((n + 1) / (t + spread)) for n, t in zip(row, total, strict=True)] for row in table.values()]
        likely[kind] = dict(zip(table, smooth, strict=True))
    return Evidence(languages, text, likely["declared"], likely["suffix"])


def _weighed(evidence: Evidence):
    """Arrow batches (id, host, declared, suffix, html) -> (id, host, log likelihood for each language)."""
    none = [0.0] * len(evidence.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for said, end, page in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                text = evidence.text[:, _buckets(visible(page or ""))].sum(1) * TEMPER
                said = evidence.declared.get(said, none) if said else none  # nothing declared says nothing
                rows.append((text + said + evidence.suffix.get(end, none)).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["id", "host", "likely"]
            )

    return run


def _normal(logs: Column) -> Column:
    """Probabilities from logarithms."""
    most = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - most))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _sums(n: int, column: str) -> list[Column]:
    return [F.sum(F.get(column, F.lit(i))).alias(f"{column}{i}") for i in range(n)]


def identify(pages: DataFrame, evidence: Evidence, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(id, host, lang, score, posterior): the likeliest language of every page, and the probabilities of all."""
    n = len(evidence.languages)
    if not n:
        return pages.select(
            F.col(key).alias("id"), urls.host(F.col(url)).alias("host"), F.lit(None).cast("string").alias("lang"),
            F.lit(0.0).alias("score"), F.array().cast("array<double>").alias("posterior"),
        )
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(
        F.col(key).alias("id"),
        urls.host(F.col(url)).alias("host"),
        declared(F.col(page)).alias("said"),
        F.coalesce(suffix(F.col(url)), F.lit("")).alias("end"),
        F.col(page).alias("page"),
    )
    weighed = settled(
        rows.mapInArrow(_weighed(evidence), f"id {kind}, host string, likely array<double>")
        .withColumn("domain", domain(F.col("host")))
        .withColumn("first", _normal(F.col("likely")))
    )
    hosts = settled(weighed.groupBy("domain", "host").agg(F.count(F.lit(1)).alias("pages"), *_sums(n, "first")))
    domains = hosts.groupBy("domain").agg(*(F.sum(f"first{i}").alias(f"domain{i}") for i in range(n)))
    every = hosts.agg(*(F.sum(f"first{i}") for i in range(n))).first()
    total = sum(x or 0.0 for x in every)
    base = [((x or 0.0) + 1) / (total + n) for x in every]
    tables = hosts.join(domains, "domain").select(
        "host", F.array(*(f"first{i}" for i in range(n))).alias("of_host"), F.array(*(f"domain{i}" for i in range(n))).alias("of_domain")
    )

    def smoothed(counts: Column, own: Column, above: Column) -> Column:
        """Counts without the page's own, with STRENGTH pages of the level above; as shares."""
        others = F.zip_with(counts, own, lambda a, b: F.greatest(a - b, F.lit(0.0)))
        size = F.aggregate(others, F.lit(STRENGTH), lambda a, x: a + x)
        return F.transform(F.zip_with(others, above, lambda a, b: a + F.lit(STRENGTH) * b), lambda x: x / size)

    levels = F.array(*map(F.lit, base))
    prior = smoothed(F.col("of_host"), F.col("first"), smoothed(F.col("of_domain"), F.col("first"), levels))
    posterior = _normal(F.zip_with("likely", prior, lambda a, b: a + F.log(b)))
    names = F.array(*map(F.lit, evidence.languages))
    return (
        weighed.join(tables, "host")
        .withColumn("posterior", posterior)
        .withColumn("score", F.array_max("posterior"))
        .withColumn("lang", F.get(names, F.array_position("posterior", F.col("score")).cast("int") - 1))
        .select("id", "host", "lang", "score", "posterior")
    )
