"""The registered queries of the numbered operators: each applies one to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.llm import (
    bpe,
    centroids,
    codes,
    exact,
    html,
    languages,
    mixing,
    quality,
    simhash,
    substrings,
    urls,
    vectors,
    weighted_sampling,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole text, decode the ids again; digests of both."""
    path = public_tokenizers.path(VOCABULARY)
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove the words of all 20-word windows that also start earlier."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@_query
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and their groups within 3 bits."""
    prints = simhash.fingerprints(_table(spark, sf_dir, "documents"))
    return simhash.groups(prints).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


@_query
def op3_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every whole text after learning from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    ranking = quality.learn(docs, _table(spark, sf_dir, "labels").where(~quality.held_out()))
    scored = docs.select("doc_id", quality.held_out().alias("held_out"), ranking.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


@_query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw all sources to their targets."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.withColumnRenamed("id", "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "source", "block", "shard", "shuffled", "shards", "places"
    )


@_query
def op6_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and kept row of every vector, whatever its label."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@_query
def op4_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are."""
    return weighted_sampling.compared(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        weighted_sampling.as_text(F.col("signature")).alias("fingerprint"),
        weighted_sampling.as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


#: Verdict, host, path.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Names of hosts of kinds that lists of domains hold, and the suffixes they come under.
LISTED_NAMES = ("adult-x", "casino-win", "free-bets", "spam-farm")
LISTED_SUFFIXES = ("example.com", "example.net", "example.org")


def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key): the hosts of LISTED_NAMES, and the canonical URLs of pages whose document is labelled toxic."""
    number = F.regexp_extract("path", r"^/[a-z]+/([0-9]{1,18})", 1)
    pages = _table(spark, sf_dir, "pages").select("url", urls.path(F.col("url")).alias("path"))
    toxic = _table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    found = (
        pages.where(number != "")
        .withColumn("doc_id", number.cast("bigint"))
        .join(toxic, "doc_id")
        .select(urls.canonical(F.col("url")).alias("key"))
    )
    hosts = F.array(*(F.lit(f"{name}.{suffix}/") for name in LISTED_NAMES for suffix in LISTED_SUFFIXES))
    return found.unionByName(spark.range(1).select(F.explode(hosts).alias("key"))).distinct()


@_query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge(pages, listed_urls(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _url_oracle() -> str:
    rules = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
        for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    hosts = ", ".join(f"('{name}.{suffix}')" for name in LISTED_NAMES for suffix in LISTED_SUFFIXES)
    return f"""WITH s AS (
      SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    c AS (SELECT *, regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '/+$', '') AS canonical,
        CASE {rules} END AS fit,
        nullif(regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})', 1), '') AS number FROM s),
    l AS (SELECT DISTINCT canonical FROM c JOIN labels ON doc_id = CAST(number AS BIGINT)
          WHERE toxic = 1 AND host <> ''),
    h AS (SELECT * FROM (VALUES {hosts}) AS t(name))
    SELECT page_id, host, path, CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 2) END AS rule,
      CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 1)
           WHEN host <> '' AND (canonical IN (SELECT canonical FROM l)
             OR EXISTS (SELECT 1 FROM h WHERE host = name OR ends_with(host, '.' || name))) THEN 'block'
           ELSE 'allow' END AS verdict
    FROM c"""


ORACLES["op5_url_filter"] = _url_oracle()


def document_number(url):
    """The document of a page, from the number in its path; null without one."""
    number = F.regexp_extract(urls.path(url), r"^/[a-z]+/([0-9]{1,18})", 1)
    return F.when(number != "", number).cast("bigint")


@_query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    pairs = html.pairs(pages, _table(spark, sf_dir, "documents"), document_number(F.col("url")))
    extracted = html.extract(pages, html.learn(pairs))
    return extracted.withColumn("n_chars", F.length("text").cast("bigint"))


def held_out_number(number):
    """Whether a document is kept from learning languages: crc32 of its id as text is divisible by five."""
    return F.coalesce(F.crc32(number.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, after learning from the documents that are not held out."""
    pages = _table(spark, sf_dir, "pages")
    docs = _table(spark, sf_dir, "documents").where(~held_out_number(F.col("doc_id")))
    evidence = languages.learn(docs, pages, document_number(F.col("url")))
    found = languages.identify(pages, evidence)
    return found.select(F.col("id").alias("page_id"), "host", "lang", F.round("score", 6).alias("score"))


@_query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector of 64 finite components after five rounds from 40 drawn centroids."""
    found, final = centroids.cluster(_table(spark, sf_dir, "embeddings"))
    digests = F.array(*(F.lit(centroids.digest(c)) for c in final)).cast("array<string>")
    return found.withColumn("centroid_sha256", F.get(digests, F.col("cluster"))).withColumnRenamed("id", "vec_id")


#: Whether a vector of ``embeddings`` has finite components only; null for a null vector.
_FINITE = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"


def _floored(total: str, n: str) -> str:
    """Integer division rounding down."""
    return f"(({total}) - ((({total}) % {n}) + {n}) % {n}) // {n}"


def _cluster_oracle(k: int = 40, rounds: int = 5) -> str:
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
    x AS MATERIALIZED (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM v),
    drawn AS (SELECT vec_id, q, row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS k FROM v),
    c0 AS MATERIALIZED (SELECT k, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM drawn WHERE k < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (SELECT vec_id, k, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS d
          FROM x JOIN c{r} c USING (i) GROUP BY vec_id, k),
        a{r} AS MATERIALIZED (SELECT vec_id, min_by(k, d * 64 + k) AS k, min(d) AS d FROM d{r} GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT k, i, {_floored("sum(x)", "count(*)")} AS x FROM a{r} JOIN x USING (vec_id) GROUP BY k, i),
            c{r + 1} AS MATERIALIZED (SELECT k, i, CAST(coalesce(m.x, c.x) AS BIGINT) AS x FROM c{r} c LEFT JOIN m{r} m USING (k, i))""")
    return f"""WITH {", ".join(steps)}, s AS (SELECT k, sha256(string_agg(x, ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY k)
    SELECT vec_id, CAST(k AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
      CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
    FROM a{rounds} JOIN s USING (k)"""


ORACLES["op11_centroid_clusters"] = _cluster_oracle()


@_query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every finite vector from four codebooks of 256 entries."""
    coded, books = codes.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"),
        codes.as_hex(F.col("entries")).alias("code"),
        "error",
        "label_error",
        F.lit(codes.digest(books)).alias("codebooks_sha256"),
    )


def _code_oracle(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, label, len(embedding) // {parts} AS w, row_number() OVER (ORDER BY vec_id) - 1 AS k,
        list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE}),
    u AS (SELECT vec_id, w, k, unnest(q) AS x, generate_subscripts(q, 1) - 1 AS i FROM v),
    x AS MATERIALIZED (SELECT vec_id, k, i // w AS p, i % w AS i, x FROM u),
    y AS MATERIALIZED (SELECT vec_id, p, list(x ORDER BY i) AS x FROM x GROUP BY vec_id, p),
    c0 AS MATERIALIZED (SELECT p, k, i, x FROM x WHERE k < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""b{r} AS MATERIALIZED (SELECT p, k, list(x ORDER BY i) AS x FROM c{r} GROUP BY p, k),
        d{r} AS (SELECT vec_id, p, k, CAST(list_sum(list_transform(list_zip(y.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
          FROM y JOIN b{r} b USING (p)),
        a{r} AS MATERIALIZED (SELECT vec_id, p, min_by(k, d * {entries} + k) AS k, min(d) AS d FROM d{r} GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT p, a.k, i, {_floored("sum(x)", "count(*)")} AS x
              FROM a{r} a JOIN x USING (vec_id, p) GROUP BY p, a.k, i),
            c{r + 1} AS MATERIALIZED (SELECT p, k, i, CAST(coalesce(m.x, c.x) AS BIGINT) AS x
              FROM c{r} c LEFT JOIN m{r} m USING (p, k, i))""")
    return f"""WITH {", ".join(steps)},
    s AS (SELECT sha256(string_agg(x, ',' ORDER BY p, k, i)) AS sha FROM c{rounds}),
    e AS (SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
    FROM e JOIN v USING (vec_id) CROSS JOIN s"""


ORACLES["op12_vector_codes"] = _code_oracle()


@_query
def op13_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of those with its text: that with the largest id."""
    return exact.groups(_table(spark, sf_dir, "documents"), keep="largest").withColumnRenamed("id", "doc_id")


ORACLES["op13_exact_groups"] = """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
