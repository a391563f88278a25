"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelfsense import schemas as S  # noqa: E402
from shelfsense.functions import scalars as sc  # noqa: E402
from shelfsense.functions.vectors import cosine, dot  # noqa: E402
from shelfsense.operators import content, corating, latent, popularity, ranking, recent, serving  # noqa: E402
from shelfsense.operators.upsert import newest_ratings, update_users, upsert_ratings  # noqa: E402
from shelfsense.plans import bindings as B  # noqa: E402
from shelfsense.shared import run_dir, settled  # noqa: E402
from shelfsense.sources import text  # noqa: E402
from shelfsense.sources.catalog import Catalog  # noqa: E402
from shelfsense.streaming.recent import current_recent_lists, start_recent_lists  # noqa: E402
from shelfsense.streaming.statistics import compact_statistics, current_statistics, start_statistics  # noqa: E402
from shelfsense.streaming.updates import current_ratings, start_rating_updates  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

# The same inputs in SQL: EV and LI ratings, P products, U users.
EV = """ev AS (
  SELECT user_id AS "userId", CAST(json_extract_string(props, '$.k') AS BIGINT) AS "productId",
         value AS score, epoch_us(ts) // 1000000 AS ts
  FROM events)"""
LI = """li AS (
  SELECT o_custkey AS "userId", l_partkey AS "productId", l_quantity / 10 AS score,
         epoch_us(l_shipdate) // 1000000 AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
P = """p AS (
  SELECT p_partkey AS "productId", p_name AS name, p_type || '|' || p_brand AS categories,
         'img/' || p_partkey || '.jpg' AS "imageUrl",
         replace(p_name, ' ', '|') || '|' || p_brand || '|' || p_type AS tags
  FROM part)"""
HASH = """list_reduce(
    list_prepend(0::BIGINT, list_transform(string_split({c}, ''), lambda c: unicode(c)::BIGINT)),
    lambda h, c: (h * 31 + c) % 4294967296)"""
U = f"""u AS (
  SELECT CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS "userId",
         username, created_ms, segment, c_custkey
  FROM (SELECT {HASH.format(c="c_name")} AS h, c_name AS username, c_custkey * 1000 AS created_ms,
               c_mktsegment AS segment, c_custkey FROM customer))"""


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


# ---- sources and sinks ------------------------------------------------------------------------


@_query("load_products", f"WITH {P} SELECT * FROM p")
def _load_products(spark, sf):
    line = F.concat_ws(
        "^", F.col("productId").cast("string"), F.concat(F.lit(" "), "name", F.lit("\t")), F.lit("1,2,3"),
        F.lit("B00CODE"), "imageUrl", F.concat("categories", F.lit(" ")), "tags",
    )
    path = run_dir(spark, "product-lines")
    B.products(spark, sf).select(line.alias("value")).write.text(path)
    return text.read_products(spark, path)


@_query("load_ratings", f"WITH {EV} SELECT * FROM ev")
def _load_ratings(spark, sf):
    path = run_dir(spark, "rating-lines")
    fields = [F.col(c).cast("string") for c in ("userId", "productId", "score", "ts")]
    B.event_ratings(spark, sf).select(F.concat_ws(",", *fields).alias("value")).write.text(path)
    return text.read_ratings(spark, path)


@_query(
    "rejected_rating_lines",
    """SELECT user_id || ',' || event_type || ',' || ts AS value FROM events WHERE event_type = 'error'""",
)
def _rejected(spark, sf):
    """Lines of error events lack a field and must all come back as rejects, the others as ratings."""
    ev = B.table(spark, sf, "events")
    bad = F.concat_ws(",", F.col("user_id").cast("string"), "event_type", F.col("ts").cast("string"))
    good = F.concat_ws(
        ",", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"),
        F.col("value").cast("string"), sc.wall_clock_seconds(F.col("ts")).cast("string"),
    )
    lines = ev.select(F.when(F.col("event_type") == "error", bad).otherwise(good).alias("value"))
    return text.split_rating_lines(lines)[1]


@_query("collection_roundtrip", f"WITH {P} SELECT * FROM p")
def _roundtrip(spark, sf):
    catalog = Catalog(spark, run_dir(spark, "catalog"))
    for _ in range(2):  # the second time replaces what the first has written
        catalog.overwrite(S.PRODUCTS_COLLECTION, B.products(spark, sf))
    return catalog.read(S.PRODUCTS_COLLECTION)


@_query("collection_append", f"WITH {EV}, {LI} SELECT * FROM ev UNION ALL SELECT * FROM li")
def _append(spark, sf):
    catalog = Catalog(spark, run_dir(spark, "catalog"))
    catalog.overwrite(S.RATING_COLLECTION, B.event_ratings(spark, sf))
    catalog.append(S.RATING_COLLECTION, B.order_ratings(spark, sf))
    return catalog.read(S.RATING_COLLECTION)


@_query(
    "rating_columns",
    f"""WITH {EV} SELECT "userId" AS uid, "productId" AS pid, score AS rating FROM ev""",
)
def _rating_columns(spark, sf):
    B.event_ratings(spark, sf).createOrReplaceTempView("rating")
    return spark.table("rating").selectExpr("userId", "productId", "score").toDF("uid", "pid", "rating")


# ---- popularity -------------------------------------------------------------------------------


@_query(
    "rate_more", f"""WITH {LI} SELECT "productId", count("productId") AS count FROM li GROUP BY 1"""
)
def _rate_more(spark, sf):
    return popularity.rate_more(B.order_ratings(spark, sf))


_MONTHLY = """m AS (
  SELECT CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INTEGER) AS yearmonth, "productId",
         count("productId") AS count
  FROM li GROUP BY 1, 2)"""


@_query("rate_more_recently", f"WITH {LI}, {_MONTHLY} SELECT * FROM m")
def _rate_more_recently(spark, sf):
    return popularity.rate_more_recently(B.order_ratings(spark, sf))


@_query(
    "average_products",
    f"""WITH {LI} SELECT "productId", round(avg(score), 9) AS avg FROM li GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def _average_products(spark, sf):
    averages = popularity.average_scores(B.order_ratings(spark, sf))
    return popularity.by_average(averages.select("productId", F.round("avg", 9).alias("avg")))


@_query(
    "hot_products",
    f"""WITH {LI}, {_MONTHLY} SELECT * FROM m ORDER BY yearmonth DESC, count DESC, "productId" LIMIT 50""",
)
def _hot(spark, sf):
    return popularity.hot(popularity.rate_more_recently(B.order_ratings(spark, sf)), 50)


@_query(
    "most_rated_products",
    f"""WITH {LI} SELECT "productId", count(*) AS count FROM li GROUP BY 1
    ORDER BY count DESC, "productId" LIMIT 50""",
)
def _most_rated(spark, sf):
    return popularity.most_rated(popularity.rate_more(B.order_ratings(spark, sf)), 50)


@_query("distinct_users", f"""WITH {LI} SELECT DISTINCT "userId" FROM li""")
def _distinct_users(spark, sf):
    return popularity.distinct_users(B.order_ratings(spark, sf))


@_query(
    "ratings_by_month_sql",
    f"""WITH {EV} SELECT CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INTEGER) AS yearmonth,
    "productId", count(*) AS count FROM ev GROUP BY 1, 2""",
)
def _by_month_sql(spark, sf):
    sc.register_sql_functions(spark)
    B.event_ratings(spark, sf).createOrReplaceTempView("rating")
    return spark.sql(
        "SELECT changeDate(ts) AS yearmonth, productId, count(productId) AS count "
        "FROM rating GROUP BY yearmonth, productId"
    )


# ---- items similar by co-rating ---------------------------------------------------------------


def _pairs_sql(source: str, dedupe: bool) -> str:
    rows = """SELECT DISTINCT "userId" AS u, "productId" AS i FROM""" if dedupe else (
        """SELECT "userId" AS u, "productId" AS i FROM"""
    )
    return f"""r AS ({rows} {source}),
    n AS (SELECT i, count(*) AS nor FROM r GROUP BY 1),
    c AS (SELECT a.i AS product1, b.i AS product2, count(*) AS common
          FROM r a JOIN r b ON a.u = b.u AND a.i <> b.i GROUP BY 1, 2),
    pairs AS (SELECT product1, product2, common, n1.nor AS nor1, n2.nor AS nor2,
                     common / sqrt(n1.nor::DOUBLE * n2.nor::DOUBLE) AS sim
              FROM c JOIN n n1 ON n1.i = product1 JOIN n n2 ON n2.i = product2),
    ranked AS (SELECT product1 AS "productId", product2 AS rid, round(sim, 6) AS r, CAST(row_number() OVER
                 (PARTITION BY product1 ORDER BY sim DESC, product2) AS INTEGER) AS rank FROM pairs)"""


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumn("r", F.round("r", digits))


@_query(
    "itemcf_pairs",
    f"WITH {EV}, {_pairs_sql('ev', True)} SELECT product1, product2, common, nor1, nor2, round(sim, 6) AS r FROM pairs",
)
def _itemcf_pairs(spark, sf):
    return _rounded(corating.with_similarity(corating.co_rating_counts(B.event_ratings(spark, sf))))


@_query("itemcf_top5", f"WITH {EV}, {_pairs_sql('ev', True)} SELECT * FROM ranked WHERE rank <= 5")
def _itemcf_top5(spark, sf):
    return _rounded(corating.similar_by_co_rating(B.event_ratings(spark, sf), 5))


@_query("itemcf_top5_raw", f"WITH {EV}, {_pairs_sql('ev', False)} SELECT * FROM ranked WHERE rank <= 5")
def _itemcf_top5_raw(spark, sf):
    return _rounded(corating.similar_by_co_rating(B.event_ratings(spark, sf), 5, dedupe=False))


@_query("itemcf_top5_orders", f"WITH {LI}, {_pairs_sql('li', True)} SELECT * FROM ranked WHERE rank <= 5")
def _itemcf_top5_orders(spark, sf):
    return _rounded(corating.similar_by_co_rating(B.order_ratings(spark, sf), 5))


@_query("itemcf_recs_nested", f"WITH {EV}, {_pairs_sql('ev', True)} SELECT * FROM ranked WHERE rank <= 5")
def _itemcf_nested(spark, sf):
    nested = ranking.nest_recs(corating.similar_by_co_rating(B.event_ratings(spark, sf), 5), "productId")
    return _rounded(ranking.unnest_recs(nested, "productId"))


# ---- items similar by content -----------------------------------------------------------------

_TFIDF = f"""{P},
    tok AS (SELECT "productId", unnest(string_split(lower(tags), '|')) AS term FROM p),
    tf AS (SELECT "productId", term, count(*) AS tf FROM tok GROUP BY 1, 2),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    w AS (SELECT "productId", term, tf, df,
                 tf * ln(((SELECT count(*) FROM p) + 1) / (df + 1)) AS weight
          FROM tf JOIN df USING (term))"""


@_query(
    "tfidf_weights", f"""WITH {_TFIDF} SELECT "productId", term, tf, df, round(weight, 6) AS weight FROM w"""
)
def _tfidf(spark, sf):
    weights = content.tfidf_weights(content.tag_words(B.products(spark, sf)))
    return weights.withColumn("weight", F.round("weight", 6))


@_query(
    "content_top5",
    f"""WITH {_TFIDF},
    norms AS (SELECT "productId" AS id, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY 1),
    dots AS (SELECT a."productId" AS id, b."productId" AS rid, sum(a.weight * b.weight) AS dot
             FROM w a JOIN w b ON a.term = b.term GROUP BY 1, 2),
    sims AS (SELECT n1.id, n2.id AS rid, round(coalesce(dot, 0) / (n1.norm * n2.norm), 6) AS r
             FROM norms n1 JOIN norms n2 ON n1.id <> n2.id AND n1.norm > 0 AND n2.norm > 0
             LEFT JOIN dots ON dots.id = n1.id AND dots.rid = n2.id),
    ranked AS (SELECT id AS "productId", rid, r,
                      CAST(row_number() OVER (PARTITION BY id ORDER BY r DESC, rid) AS INTEGER) AS rank
               FROM sims)
    SELECT * FROM ranked WHERE rank <= 5""",
)
def _content_top5(spark, sf):
    return content.similar_by_content(B.products(spark, sf), 5)


@_query(
    "content_top5_whole_tags",
    f"""WITH {P}, n AS (SELECT tags, count(*) AS df FROM p GROUP BY 1),
    v AS (SELECT "productId", lower(tags) AS t FROM p JOIN n USING (tags) WHERE df < (SELECT count(*) FROM p)),
    sims AS (SELECT a."productId", b."productId" AS rid, CASE WHEN a.t = b.t THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS r
             FROM v a JOIN v b ON a."productId" <> b."productId"),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY "productId" ORDER BY r DESC, rid) AS INTEGER) AS rank
               FROM sims)
    SELECT * FROM ranked WHERE rank <= 5""",
)
def _content_whole(spark, sf):
    """A product's tag list taken as one word: similarity is one for equal lists and else zero."""
    return content.similar_by_content(B.products(spark, sf), 5, separator=None)


def _murmur3(word: str) -> str:
    """The 32-bit Murmur3 hash, seed 42, of an ASCII word, as an unsigned number."""
    byte = f"unicode({word}[{{}}])::HUGEINT"
    rotated = "(({0} << {1}) % 4294967296 + ({0} >> {2}))"
    mixed = lambda k: f"({rotated.format(f'(({k}) * 3432918353 % 4294967296)', 15, 17)} * 461845907 % 4294967296)"
    block = " + ".join(f"({byte.format(f'4 * i + {b + 1}')} << {8 * b})" for b in range(4))
    tail = " + ".join(
        f"(CASE WHEN len({word}) % 4 > {b} THEN {byte.format(f'len({word}) // 4 * 4 + {b + 1}')} << {8 * b} ELSE 0 END)"
        for b in range(3)
    )
    body = f"""list_reduce(list_prepend(42::HUGEINT, list_transform(range(len({word}) // 4), lambda i: {mixed(block)})),
        lambda h, k: ({rotated.format("xor(h, k)", 13, 19)} * 5 + 3864292196) % 4294967296)"""
    steps = [f"{body} AS h0", f"xor(xor(h0, {mixed(tail)}), len({word})::HUGEINT) AS h1"]
    steps += ["xor(h1, h1 >> 16) * 2246822507 % 4294967296 AS h2", "xor(h2, h2 >> 13) * 3266489909 % 4294967296 AS h3"]
    return ", ".join([*steps, "xor(h3, h3 >> 16) AS hash"])


@_query(
    "content_top5_hashed",
    f"""WITH {P},
    tok AS (SELECT "productId", unnest(string_split(lower(tags), '|')) AS term FROM p),
    words AS (SELECT DISTINCT term FROM tok),
    hashed AS (SELECT term, {_murmur3("term")} FROM words),
    bucket AS (SELECT term, ((CASE WHEN hash >= 2147483648 THEN hash - 4294967296 ELSE hash END) % 189 + 189) % 189 AS b
               FROM hashed),
    tf AS (SELECT "productId", b, count(*) AS tf FROM tok JOIN bucket USING (term) GROUP BY 1, 2),
    df AS (SELECT b, count(*) AS df FROM tf GROUP BY 1),
    w AS (SELECT "productId", b, tf * ln(((SELECT count(*) FROM p) + 1) / (df + 1)) AS weight FROM tf JOIN df USING (b)),
    norms AS (SELECT "productId" AS id, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY 1),
    dots AS (SELECT x."productId" AS id, y."productId" AS rid, sum(x.weight * y.weight) AS dot
             FROM w x JOIN w y ON x.b = y.b GROUP BY 1, 2),
    sims AS (SELECT n1.id, n2.id AS rid, round(coalesce(dot, 0) / (n1.norm * n2.norm), 6) AS r
             FROM norms n1 JOIN norms n2 ON n1.id <> n2.id AND n1.norm > 0 AND n2.norm > 0
             LEFT JOIN dots ON dots.id = n1.id AND dots.rid = n2.id),
    ranked AS (SELECT id AS "productId", rid, r,
                      CAST(row_number() OVER (PARTITION BY id ORDER BY r DESC, rid) AS INTEGER) AS rank
               FROM sims)
    SELECT * FROM ranked WHERE rank <= 5""",
)
def _content_hashed(spark, sf):
    return content.similar_by_content(B.products(spark, sf), 5, hashed=True)


# ---- latent factors ---------------------------------------------------------------------------

_DOT = "list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"
_NORM = "sqrt(list_dot_product({0}.embedding::DOUBLE[], {0}.embedding::DOUBLE[]))"
_COS = f"{_DOT} / ({_NORM.format('a')} * {_NORM.format('b')})"


@_query(
    "factor_sim_top10",
    f"""WITH sims AS (SELECT a.vec_id AS id, b.vec_id AS rid, {_COS} AS sim
                      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    ranked AS (SELECT id AS "productId", rid, round(sim, 6) AS r, CAST(row_number() OVER
               (PARTITION BY id ORDER BY round(sim, 6) DESC, rid) AS INTEGER) AS rank FROM sims WHERE sim > 0.3)
    SELECT * FROM ranked WHERE rank <= 10""",
)
def _factor_sim(spark, sf):
    return latent.similar_by_factors(B.vectors(spark, sf), 10, above=0.3)


@_query(
    "user_product_top20",
    f"""WITH scores AS (SELECT a.vec_id AS id, b.vec_id AS rid, {_DOT} AS s FROM embeddings a JOIN embeddings b ON true),
    ranked AS (SELECT id AS "userId", rid, round(s, 6) AS r, CAST(row_number() OVER
               (PARTITION BY id ORDER BY round(s, 6) DESC, rid) AS INTEGER) AS rank FROM scores WHERE s > 0)
    SELECT * FROM ranked WHERE rank <= 20""",
)
def _user_product(spark, sf):
    """All users scored against all products, the embeddings standing in for both factor tables."""
    vectors = B.vectors(spark, sf)
    return latent.score_top_k(vectors, vectors, 20)


@_query(
    "vector_cosine",
    f"""SELECT a.vec_id, b.vec_id AS next_id, round({_COS}, 6) AS r
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def _vector_cosine(spark, sf):
    a = B.vectors(spark, sf).select(F.col("id").alias("vec_id"), F.col("vec").alias("va"))
    b = B.vectors(spark, sf).select(
        (F.col("id") - 1).alias("vec_id"), F.col("id").alias("next_id"), F.col("vec").alias("vb")
    )
    return a.join(b, "vec_id").select(
        "vec_id", "next_id", F.round(cosine(F.col("va"), F.col("vb")), 6).alias("r")
    )


@_query("als_user_recs")
def _als_user_recs(spark, sf):
    model = latent.fit_als(B.event_ratings(spark, sf))
    return latent.recommend_to_users(model, B.products(spark, sf))


@_query("als_item_sim")
def _als_item_sim(spark, sf):
    model = latent.fit_als(B.event_ratings(spark, sf))
    return latent.similar_by_factors(latent.factors(model.itemFactors))


_TRAINED = f"""{EV}, pairs AS (SELECT DISTINCT "userId", "productId" FROM ev)"""


@_query(
    "als_predictions",
    f"""WITH {_TRAINED} SELECT *, true AS "isDotProduct" FROM pairs""",
)
def _als_predictions(spark, sf):
    """All rated pairs, and as many with an unknown user or product, which must vanish."""
    ratings = B.event_ratings(spark, sf)
    model = latent.fit_als(ratings)
    rated = ratings.select("userId", "productId").distinct()
    asked = rated.unionByName(rated.select(-1 - F.col("userId"), "productId").toDF(*rated.columns)).unionByName(
        rated.select("userId", -1 - F.col("productId")).toDF(*rated.columns)
    )
    users, items = latent.factors(model.userFactors), latent.factors(model.itemFactors)
    own = dot(F.col("user_vec"), F.col("item_vec"))
    return (
        latent.predict(model, asked)
        .join(users.toDF("userId", "user_vec"), "userId")
        .join(items.toDF("productId", "item_vec"), "productId")
        .select("userId", "productId", (F.abs(own - F.col("prediction")) < 1e-3).alias("isDotProduct"))
    )


@_query(
    "als_user_solutions",
    f"""WITH {_TRAINED} SELECT "userId", count(*) AS n, true AS solved FROM pairs GROUP BY 1""",
)
def _als_user_solutions(spark, sf):
    """Every user's factors solve the regularised least squares of the ratings, given the products' factors."""
    ratings = latent.newest_per_pair(B.event_ratings(spark, sf))
    model = latent.fit_als(ratings, dedupe=False)
    return latent.user_residuals(ratings, model).select(
        "userId", "n", (F.col("residual") <= 1e-3 * F.col("scale")).alias("solved")
    )


@_query(
    "als_user_lists",
    f"""WITH {_TRAINED} SELECT DISTINCT "userId", true AS bounded, true AS positive, true AS descending, true AS "distinct",
      true AS in_catalogue, true AS predicted FROM pairs""",
)
def _als_user_lists(spark, sf):
    """What must hold of every trained user's list; one without positive predictions has an empty list."""
    ratings, products = B.event_ratings(spark, sf), B.products(spark, sf)
    model = latent.fit_als(ratings)
    rows = (
        latent.recommend_to_users(model, products)
        .join(products.select(F.col("productId").alias("rid"), F.lit(True).alias("known")), "rid", "left")
        .join(latent.factors(model.userFactors).toDF("userId", "user_vec"), "userId", "left")
        .join(latent.factors(model.itemFactors).toDF("rid", "item_vec"), "rid", "left")
        .withColumn("error", F.abs(dot(F.col("user_vec"), F.col("item_vec")) - F.col("r")))
    )
    in_order = F.array_sort(F.collect_list(F.struct("rank", "r", "rid")))
    lists = rows.groupBy("userId").agg(
        in_order.alias("l"), F.min("r").alias("least"), F.count("known").alias("n_known"),
        F.countDistinct("rid").alias("n_rid"), F.max("error").alias("error"), F.count("error").alias("n_error"),
    )
    n = F.size("l")
    falling = F.forall(
        F.sequence(F.lit(1), n),
        lambda i: (F.get("l", i - 1)["rank"] == i) & ((i == 1) | (F.get("l", i - 2)["r"] >= F.get("l", i - 1)["r"])),
    )
    checks = {
        "bounded": n <= latent.USER_LIST, "positive": F.col("least") > 0, "descending": falling,
        "distinct": F.col("n_rid") == n, "in_catalogue": F.col("n_known") == n,
        "predicted": (F.col("n_error") == n) & (F.col("error") < 1e-5),
    }
    trained = ratings.select("userId").distinct()
    return trained.join(lists, "userId", "left").select(
        "userId", *(F.coalesce(c, F.lit(True)).alias(name) for name, c in checks.items())
    )


@_query(
    "als_item_lists",
    f"""WITH {_TRAINED} SELECT DISTINCT "productId", true AS bounded, true AS strong, true AS cosines, true AS mutual FROM pairs""",
)
def _als_item_lists(spark, sf):
    """What must hold of every trained product's list, which is empty where nothing is alike enough."""
    ratings = B.event_ratings(spark, sf)
    items = latent.factors(latent.fit_als(ratings).itemFactors)
    found = settled(latent.similar_by_factors(items))
    lists = found.groupBy("productId").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("least"))
    back = found.select(F.col("rid").alias("productId"), F.col("productId").alias("rid"), F.lit(True).alias("listed"))
    ends = lists.select(F.col("productId").alias("rid"), F.col("n").alias("other_n"), F.col("least").alias("other_least"))
    # where a partner's list has room, or ends below this similarity, the product must stand in it
    room = (F.col("other_n") < latent.ITEM_LIST) | (F.col("other_least") < F.col("r"))
    rows = (
        found.join(items.toDF("productId", "v1"), "productId")
        .join(items.toDF("rid", "v2"), "rid")
        .join(ends, "rid", "left")
        .join(back, ["productId", "rid"], "left")
        .withColumn("mutual", F.coalesce("listed", ~F.coalesce(room, F.lit(True))))
        .withColumn("exact", F.abs(cosine(F.col("v1"), F.col("v2")) - F.col("r")) < 1e-5)
    )
    checked = rows.groupBy("productId").agg(
        (F.max("rank") <= latent.ITEM_LIST).alias("bounded"), (F.min("r") >= latent.STRONG).alias("strong"),
        F.every("exact").alias("cosines"), F.every("mutual").alias("mutual"),
    )
    trained = ratings.select("productId").distinct()
    return trained.join(checked, "productId", "left").select(
        "productId", *(F.coalesce(c, F.lit(True)).alias(c) for c in ("bounded", "strong", "cosines", "mutual"))
    )


# ---- serving ----------------------------------------------------------------------------------

_AVG = """av AS (SELECT "productId", avg(score) AS avg FROM {0} GROUP BY 1)"""


@_query(
    "product_with_score",
    f"""WITH {P}, {EV}, {_AVG.format('ev')}
    SELECT p.*, round(coalesce(avg, 0.0), 9) AS score FROM p LEFT JOIN av USING ("productId")""",
)
def _product_with_score(spark, sf):
    """Only the first hundred products have ratings in the events; the others get 0.0."""
    averages = popularity.average_scores(B.event_ratings(spark, sf))
    scored = serving.with_score(B.products(spark, sf), averages)
    return scored.withColumn("score", F.round("score", 9))


@_query(
    "enrich_recs",
    f"""WITH {P}, {EV}, {_pairs_sql('ev', True)}, {_AVG.format('ev')}
    SELECT ranked."productId", rank, rid, r, name, categories, "imageUrl", tags,
           round(coalesce(avg, 0.0), 9) AS score
    FROM ranked JOIN p ON p."productId" = rid LEFT JOIN av ON av."productId" = rid
    WHERE rank <= 6 AND ranked."productId" IN (SELECT "productId" FROM p)""",
)
def _enrich(spark, sf):
    """Lists of eight, requested for every product, cut to six and completed."""
    ratings, products = B.event_ratings(spark, sf), B.products(spark, sf)
    recs = ranking.nest_recs(corating.similar_by_co_rating(ratings, 8), "productId")
    rows = serving.recs_for_products(products, recs, first=6)
    full = serving.enrich(_rounded(rows), products, popularity.average_scores(ratings))
    return full.withColumn("score", F.round("score", 9))


@_query(
    "hot_product_details",
    f"""WITH {P}, {LI}, {_MONTHLY}, {_AVG.format('li')},
    hot AS (SELECT "productId" AS rid, yearmonth, CAST(row_number() OVER
              (ORDER BY yearmonth DESC, count DESC, "productId") AS INTEGER) AS rank FROM m
            ORDER BY yearmonth DESC, count DESC, "productId" LIMIT 50)
    SELECT hot.*, name, categories, "imageUrl", tags, round(coalesce(avg, 0.0), 9) AS score
    FROM hot JOIN p ON p."productId" = rid LEFT JOIN av ON av."productId" = rid""",
)
def _hot_details(spark, sf):
    ratings = B.order_ratings(spark, sf)
    best = popularity.hot(popularity.rate_more_recently(ratings), 50)
    # at most fifty rows here, so numbering them in one place is free
    rank = F.expr("row_number() OVER (ORDER BY yearmonth DESC, count DESC, productId)")
    rows = best.select(F.col("productId").alias("rid"), "yearmonth", rank.alias("rank"))
    full = serving.enrich(rows, B.products(spark, sf), popularity.average_scores(ratings))
    return full.withColumn("score", F.round("score", 9))


def _customer_recs(spark, sf, key: str) -> DataFrame:
    """A list of at most twenty products per customer, by the score they gave on average."""
    ratings = B.order_ratings(spark, sf)
    own = ratings.groupBy("userId", "productId").agg(F.round(F.avg("score"), 6).alias("r"))
    ids = B.users(spark, sf).select(F.col("c_custkey"), F.col("userId").alias(key))
    rows = own.join(ids, own.userId == ids.c_custkey).select(
        F.col(key).cast("bigint").alias(key) if key != "userId" else ids["userId"].cast("bigint").alias(key),
        F.col("productId").alias("rid"),
        "r",
    )
    return ranking.nest_recs(ranking.top_per_key(rows, key, 20), key)


_CUSTOMER_RECS = f"""{LI}, {U},
    own AS (SELECT "userId" AS k, "productId" AS rid, round(avg(score), 6) AS r FROM li GROUP BY 1, 2),
    ranked AS (SELECT k, rid, r, CAST(row_number() OVER (PARTITION BY k ORDER BY r DESC, rid) AS INTEGER) AS rank
               FROM own)"""


@_query(
    "recs_for_usernames",
    f"""WITH {_CUSTOMER_RECS}
    SELECT username, rank, rid, r FROM ranked JOIN u ON c_custkey = k WHERE rank <= 20""",
)
def _recs_for_usernames(spark, sf):
    users = B.users(spark, sf)
    return serving.recs_for_usernames(users.select("username"), users, _customer_recs(spark, sf, "userId"))


@_query(
    "stream_recs_for_usernames",
    f"""WITH {_CUSTOMER_RECS}
    SELECT username, rank, rid, r FROM ranked JOIN u ON c_custkey = k WHERE rank <= 6""",
)
def _stream_recs_for_usernames(spark, sf):
    """The same through the differently named fields of the streaming collection."""
    users = B.users(spark, sf)
    recs = _customer_recs(spark, sf, "userId").select(
        "userId",
        F.transform("recs", lambda x: F.struct(x["rid"].alias("productId"), x["r"].alias("score"))).alias("recs"),
    )
    catalog = Catalog(spark, run_dir(spark, "catalog"))
    catalog.overwrite(S.STREAM_RECS_COLLECTION, recs)
    recs = ranking.stream_recs_as_recs(catalog.read(S.STREAM_RECS_COLLECTION))
    return serving.recs_for_usernames(users.select("username"), users, recs, first=6)


@_query(
    "detailed_recs_for_usernames",
    f"""WITH {P}, {_CUSTOMER_RECS}, {_AVG.format('li')}
    SELECT username, rank, rid, r, name, categories, "imageUrl", tags, round(coalesce(avg, 0.0), 9) AS score
    FROM ranked JOIN u ON c_custkey = k JOIN p ON p."productId" = rid LEFT JOIN av ON av."productId" = rid WHERE rank <= 6""",
)
def _detailed_recs(spark, sf):
    """Names to ids, lists, product details and scores."""
    users = B.users(spark, sf)
    averages = popularity.average_scores(B.order_ratings(spark, sf))
    full = serving.detailed_recs_for_usernames(
        users.select("username"), users, _customer_recs(spark, sf, "userId"), B.products(spark, sf), averages, first=6
    )
    return full.withColumn("score", F.round("score", 9))


@_query(
    "scored_products_by_ids",
    f"""WITH {P}, {EV}, {_AVG.format('ev')}
    SELECT p.*, round(coalesce(avg, 0.0), 9) AS score FROM p LEFT JOIN av USING ("productId")
    WHERE "productId" IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 25)""",
)
def _scored_products(spark, sf):
    """Products ordered in large quantities; most of them have no rating among the events."""
    ids = B.table(spark, sf, "lineitem").where("l_quantity > 25").select(F.col("l_partkey").alias("productId"))
    averages = popularity.average_scores(B.event_ratings(spark, sf))
    found = serving.scored_products_by_ids(B.products(spark, sf), averages, ids)
    return found.withColumn("score", F.round("score", 9))


@_query(
    "ratings_from_requests",
    f"""WITH {U} SELECT "userId", l_partkey AS "productId", l_linenumber / 2 AS score, epoch_us(l_shipdate) // 1000000 AS ts,
      'userId:' || "userId" AS queue, l_partkey || ':' || CAST(l_linenumber / 2 AS VARCHAR) AS entry
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN u ON c_custkey = o_custkey WHERE l_returnflag <> 'R'""",
)
def _ratings_from_requests(spark, sf):
    """An order line as a request of its customer; those of returned goods come under a name nobody has."""
    users = B.users(spark, sf)
    lines, orders = B.table(spark, sf, "lineitem"), B.table(spark, sf, "orders")
    named = orders.join(users, orders.o_custkey == users.c_custkey).select("o_orderkey", "username")
    name = F.when(F.col("l_returnflag") == "R", F.concat("username", F.lit("?"))).otherwise(F.col("username"))
    requests = lines.join(named, lines.l_orderkey == named.o_orderkey).select(
        name.alias("username"), F.col("l_partkey").alias("productId"), F.col("l_linenumber").alias("stars"),
        sc.wall_clock_seconds(F.col("l_shipdate")).alias("ts"),
    )
    rated = serving.ratings_from_requests(requests, users)
    return rated.select(
        F.col("userId").cast("int").alias("userId"), "productId", "score", "ts",
        sc.queue_key(F.col("userId")).alias("queue"), sc.queue_entry(F.col("productId"), F.col("score")).alias("entry"),
    )


@_query(
    "register_users",
    f"""WITH {U}, n AS (SELECT DISTINCT {HASH.format(c="s_name")} AS h, s_name AS username FROM supplier)
    SELECT CAST("userId" AS BIGINT) AS "userId", username, false AS is_new, true AS "first", true AS timely FROM u
    UNION ALL
    SELECT CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END, username, true, true, true FROM n""",
)
def _register_users(spark, sf):
    """Customers are users already; all of them and all suppliers ask to be registered, some twice."""
    users = B.users(spark, sf).drop("c_custkey")
    names = B.table(spark, sf, "supplier").select(F.col("s_name").alias("username"))
    asked = names.unionByName(names).unionByName(users.select("username"))
    catalog = Catalog(spark, run_dir(spark, "catalog"))
    shape = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.USER.fields]
    catalog.overwrite(S.USER_COLLECTION, users.select(*shape))
    catalog.append(S.USER_COLLECTION, serving.new_users(asked, users).select(*shape))
    is_new = F.col("prefGenres").isNull()
    # registered within the last day, by either clock column
    age = sc.now_seconds() - F.floor(F.col("created_ms") / 1000)
    timely = ~is_new | ((age >= 0) & (age < 86_400) & (sc.now_millis() - F.col("created_ms") < 86_400_000))
    return catalog.read(S.USER_COLLECTION).select(
        F.col("userId").cast("bigint").alias("userId"), "username", is_new.alias("is_new"), "first", timely.alias("timely")
    )


@_query("product_search", f"WITH {P} SELECT * FROM p WHERE regexp_matches(name, '^(red|small) .*[gt]')")
def _search(spark, sf):
    return serving.search(B.products(spark, sf), "^(red|small) .*[gt]")


@_query(
    "product_search_many",
    f"""WITH {P}, q AS (SELECT unnest(['ring', '^blue', '(?i)WIDGET$']) AS pattern)
    SELECT pattern, p.* FROM p JOIN q ON regexp_matches(name, pattern)""",
)
def _search_many(spark, sf):
    return serving.search(B.products(spark, sf), ["ring", "^blue", "(?i)WIDGET$"])


_PATTERNS = """
    SELECT DISTINCT '^' || p_name || '$' AS pattern FROM part
    UNION SELECT DISTINCT regexp_extract(p_name, '^[a-z]+') || ' .*[gt]$' FROM part
    UNION SELECT DISTINCT '(?i) ' || upper(regexp_extract(p_name, '[a-z]+$')) FROM part
    UNION SELECT DISTINCT '^' || lower(substr(n_name, 1, 1)) || '[a-z]+ ' || lower(substr(n_name, 2, 1)) FROM nation"""


@_query(
    "product_search_table",
    f"""WITH {P}, q AS ({_PATTERNS}),
    ratings AS (SELECT l_partkey AS "productId", avg(l_quantity / 10) AS score FROM lineitem JOIN orders
                ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT pattern, p.*, round(coalesce(score, 0), 6) AS score
    FROM p JOIN q ON regexp_matches(name, pattern) LEFT JOIN ratings USING ("productId")""",
)
def _search_table(spark, sf):
    """Patterns from names and nations: most name text that their matches hold, some leave it open."""
    name, nation = F.col("p_name"), F.lower("n_name")
    parts = B.table(spark, sf, "part")
    made = [
        F.concat(F.lit("^"), name, F.lit("$")),
        F.concat(F.regexp_extract(name, "^[a-z]+", 0), F.lit(" .*[gt]$")),
        F.concat(F.lit("(?i) "), F.upper(F.regexp_extract(name, "[a-z]+$", 0))),
    ]
    initials = F.concat(F.lit("^"), F.substring(nation, 1, 1), F.lit("[a-z]+ "), F.substring(nation, 2, 1))
    patterns = parts.select(F.explode(F.array(*made)).alias("pattern")).unionByName(
        B.table(spark, sf, "nation").select(initials.alias("pattern"))
    )
    averages = popularity.average_scores(B.order_ratings(spark, sf))
    found = serving.search_table(B.products(spark, sf), patterns, averages)
    return found.withColumn("score", F.round("score", 6))


@_query("products_by_ids", f"""WITH {P}, {EV} SELECT * FROM p WHERE "productId" IN (SELECT "productId" FROM ev)""")
def _products_by_ids(spark, sf):
    return serving.products_by_ids(B.products(spark, sf), B.event_ratings(spark, sf))


@_query("product_by_id", f"""WITH {P} SELECT * FROM p WHERE "productId" = 42""")
def _product_by_id(spark, sf):
    return serving.product_by_id(B.products(spark, sf), 42)


@_query(
    "user_by_name",
    f"""WITH {U} SELECT "userId", username, created_ms FROM u WHERE username = 'Customer#000000042'""",
)
def _user_by_name(spark, sf):
    users = B.users(spark, sf).select("userId", "username", "created_ms")
    return serving.user_by_name(users, "Customer#000000042")


@_query(
    "rating_lookup",
    f"""WITH {EV}, q AS (SELECT user_id AS "userId", CAST(json_extract_string(props, '$.k') AS BIGINT) AS "productId"
                         FROM events WHERE event_type = 'purchase'),
    hit AS (SELECT *, row_number() OVER (PARTITION BY "userId", "productId" ORDER BY ts DESC, score DESC) AS rn
            FROM ev SEMI JOIN q USING ("userId", "productId"))
    SELECT "userId", "productId", score, ts FROM hit WHERE rn = 1""",
)
def _rating_lookup(spark, sf):
    """The newest rating of every pair that was ever purchased."""
    bought = B.table(spark, sf, "events").where("event_type = 'purchase'")
    pairs = bought.select(
        F.col("user_id").alias("userId"), F.get_json_object("props", "$.k").cast("bigint").alias("productId")
    )
    return serving.ratings_of_pairs(B.event_ratings(spark, sf), pairs)


@_query(
    "first_rating",
    f"""WITH {LI}, o AS (SELECT *, row_number() OVER
          (PARTITION BY "userId" ORDER BY ts DESC, "productId", score DESC) AS rn FROM li)
    SELECT "userId", "productId", score, ts FROM o WHERE rn = 1""",
)
def _first_rating(spark, sf):
    return serving.first_rating(B.order_ratings(spark, sf))


# ---- upserts ----------------------------------------------------------------------------------

_SPLIT = 1705276800  # 2024-01-15T00:00:00Z


def _upsert_sql(ts: str) -> str:
    return f"""WITH {EV}, t AS (SELECT *, ts >= {_SPLIT} AS upd FROM ev),
    s AS (SELECT *, row_number() OVER (PARTITION BY "userId", "productId"
                                       ORDER BY upd DESC, ts DESC, score DESC) AS rn FROM t),
    a AS (SELECT "userId", "productId", max(ts) FILTER (NOT upd) AS base_ts,
                 min(ts) FILTER (upd) AS first_ts, max(ts) AS last_ts FROM t GROUP BY 1, 2)
    SELECT "userId", "productId", score, {ts} AS ts FROM s JOIN a USING ("userId", "productId") WHERE rn = 1"""


def _base_and_updates(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The older half as a snapshot, as the raw events hold repeats of a pair, and the updates as they came."""
    ratings = B.event_ratings(spark, sf)
    return newest_ratings(ratings.where(F.col("ts") < _SPLIT)), ratings.where(F.col("ts") >= _SPLIT)


@_query("rating_upsert", _upsert_sql("coalesce(base_ts, first_ts)"))
def _rating_upsert(spark, sf):
    return upsert_ratings(*_base_and_updates(spark, sf))


@_query("rating_upsert_touch", _upsert_sql("last_ts"))
def _rating_upsert_touch(spark, sf):
    return upsert_ratings(*_base_and_updates(spark, sf), touch_ts=True)


@_query(
    "user_update",
    f"""WITH {U}, o AS (SELECT o_custkey, o_orderpriority || '|' || o_orderstatus AS genres, row_number() OVER
          (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderstatus DESC) AS rn
        FROM orders)
    SELECT "userId", username, genres IS NULL AS first, created_ms, coalesce(genres, segment) AS genres
    FROM u LEFT JOIN (SELECT * FROM o WHERE rn = 1) n ON o_custkey = c_custkey""",
)
def _user_update(spark, sf):
    """Every order updates its customer's profile."""
    users = B.users(spark, sf)
    orders = B.table(spark, sf, "orders")
    updates = orders.join(users, orders.o_custkey == users.c_custkey).select(
        "userId",
        F.lit(False).alias("first"),
        F.array("o_orderpriority", "o_orderstatus").alias("prefGenres"),
        (sc.wall_clock_seconds(F.col("o_orderdate")) * 1000).alias("updated_ms"),
    )
    updated = update_users(users.drop("c_custkey"), updates)
    return updated.withColumn("genres", F.array_join("prefGenres", "|")).drop("prefGenres")


# ---- recent ratings and rating events ---------------------------------------------------------

_RECENT = f"""{EV}, o AS (SELECT *, CAST(row_number() OVER
      (PARTITION BY "userId" ORDER BY ts DESC, "productId", score DESC) AS INTEGER) AS pos FROM ev),
    recent AS (SELECT * FROM o WHERE pos <= 40)"""


@_query("recent_ratings_40", f"""WITH {_RECENT} SELECT "userId", "productId", score, ts, pos FROM recent""")
def _recent(spark, sf):
    return recent.unnest_recent(recent.recent_lists(B.event_ratings(spark, sf)))


_HALF = "(CAST(round(score * 100) AS BIGINT) + 1) // 2 / 100.0"


@_query(
    "recent_queue_entries",
    f"""WITH {_RECENT} SELECT 'userId:' || "userId" AS queue, pos,
        "productId" || ':' || CAST({_HALF} AS VARCHAR) AS entry FROM recent""",
)
def _queue(spark, sf):
    rows = recent.recent_ratings(B.event_ratings(spark, sf))
    return recent.queue_entries(rows.withColumn("score", sc.halved_score(F.col("score"))))


_LOG_HEAD = "2024-02-01 10:00:00,000   INFO --- [main]  rating  :  "


def _write_log(spark, sf, files: int | None = None) -> str:
    """Rating events of all ratings, each followed by a line that is none, as log files."""
    event = sc.rating_event(F.col("userId"), F.col("productId"), sc.halved_score(F.col("score")), F.col("ts"))
    noise = F.concat(F.lit("WARN no rating by user "), F.col("userId").cast("string"))
    lines = B.event_ratings(spark, sf).select(
        F.explode(F.array(F.concat(F.lit(_LOG_HEAD), event), noise)).alias("value")
    )
    path = run_dir(spark, "rating-log")
    (lines if files is None else lines.repartition(files)).write.text(path)
    return path


@_query("rating_log_parse", f"""WITH {EV} SELECT "userId", "productId", {_HALF} AS score, ts FROM ev""")
def _log_parse(spark, sf):
    return text.read_rating_log(spark, _write_log(spark, sf))


@_query(
    "rating_log_lines",
    f"""WITH {EV} SELECT "userId", 'PRODUCT_RATING_PREFIX:' || "userId" || '|' || "productId" || '|'
        || CAST({_HALF} AS VARCHAR) || '|' || ts AS value FROM ev""",
)
def _log_lines(spark, sf):
    event = sc.rating_event(F.col("userId"), F.col("productId"), sc.halved_score(F.col("score")), F.col("ts"))
    return B.event_ratings(spark, sf).select("userId", event.alias("value"))


def _stream_session(spark: SparkSession) -> SparkSession:
    """Same application, own settings: a stateful stream fixes its number of shuffle partitions."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


@_query(
    "stream_recent_ratings",
    f"""WITH {EV}, h AS (SELECT "userId", "productId", {_HALF} AS score, ts FROM ev),
    o AS (SELECT *, CAST(row_number() OVER
      (PARTITION BY "userId" ORDER BY ts DESC, "productId", score DESC) AS INTEGER) AS pos FROM h)
    SELECT * FROM o WHERE pos <= 40""",
)
def _stream_recent(spark, sf):
    log, base = _write_log(spark, sf, files=3), run_dir(spark, "stream-recent")
    ratings = text.stream_rating_log(_stream_session(spark), log, files_per_batch=1)
    start_recent_lists(ratings, f"{base}/lists", f"{base}/checkpoint", available_now=True).awaitTermination()
    return recent.unnest_recent(current_recent_lists(spark, f"{base}/lists"))


def _streamed_statistics(spark, sf):
    """Partial statistics: two runs over a growing log, with those of the first compacted in between."""
    log, base = _write_log(spark, sf, files=3), run_dir(spark, "stream-statistics")
    for run in ("first", "second"):
        ratings = text.stream_rating_log(_stream_session(spark), log, files_per_batch=1)
        start_statistics(ratings, f"{base}/{run}", f"{base}/checkpoint", available_now=True).awaitTermination()
        if run == "first":
            compact_statistics(spark, [f"{base}/first"], f"{base}/compact")
            spark.read.text(log).repartition(2).write.mode("append").text(log)
    return current_statistics(spark, f"{base}/compact", f"{base}/second")


@_query(
    "stream_average_products",
    f"""WITH {EV}, h AS (SELECT "productId", {_HALF} AS score FROM ev)
    SELECT "productId", 2 * count("productId") AS count, round(avg(score), 9) AS avg FROM h GROUP BY 1""",
)
def _stream_averages(spark, sf):
    """Counts and averages of a log that arrives a second time, as batches add up."""
    found = popularity.statistics_of(_streamed_statistics(spark, sf))
    return found.withColumn("avg", F.round("avg", 9))


@_query(
    "stream_rate_more_recently",
    f"""WITH {EV} SELECT CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INTEGER) AS yearmonth, "productId",
      2 * count("productId") AS count FROM ev GROUP BY 1, 2""",
)
def _stream_monthly(spark, sf):
    return _streamed_statistics(spark, sf).select("yearmonth", "productId", "count")


@_query(
    "stream_replayed_events",
    f"""WITH {EV} SELECT DISTINCT "userId", "productId", {_HALF} AS score, ts FROM ev""",
)
def _stream_replayed(spark, sf):
    """Log files that arrive twice, the second time in other pieces; every event comes out once."""
    log, base = _write_log(spark, sf, files=3), run_dir(spark, "stream-replayed")
    spark.read.text(log).repartition(2).write.mode("append").text(log)
    ratings = text.stream_rating_log(_stream_session(spark), log, files_per_batch=2)
    once = text.distinct_events(ratings, late="3650 days")
    written = once.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
    written.trigger(availableNow=True).start(f"{base}/events").awaitTermination()
    return spark.read.schema(S.RATING).parquet(f"{base}/events")


@_query("collection_replaced_by_itself", f"""WITH {EV} SELECT * FROM ev WHERE score > 10 UNION ALL SELECT * FROM ev WHERE score > 10""")
def _replaced(spark, sf):
    """A collection cut to what is read from it, extended by itself, then compacted."""
    catalog = Catalog(spark, run_dir(spark, "catalog"))
    catalog.overwrite(S.RATING_COLLECTION, B.event_ratings(spark, sf))
    catalog.overwrite(S.RATING_COLLECTION, catalog.read(S.RATING_COLLECTION).where("score > 10"))
    catalog.append(S.RATING_COLLECTION, catalog.read(S.RATING_COLLECTION))
    catalog.compact(S.RATING_COLLECTION)
    catalog.vacuum(S.RATING_COLLECTION)
    return catalog.read(S.RATING_COLLECTION)


@_query(
    "stream_upsert",
    f"""WITH {EV}, t AS (
      SELECT "userId", "productId", score, ts, false AS upd FROM ev WHERE ts < {_SPLIT}
      UNION ALL SELECT "userId", "productId", {_HALF} AS score, ts, true AS upd FROM ev),
    s AS (SELECT *, row_number() OVER (PARTITION BY "userId", "productId"
                                       ORDER BY upd DESC, ts DESC, score DESC) AS rn FROM t),
    a AS (SELECT "userId", "productId", max(ts) FILTER (NOT upd) AS base_ts, min(ts) FILTER (upd) AS first_ts
          FROM t GROUP BY 1, 2)
    SELECT "userId", "productId", score, coalesce(base_ts, first_ts) AS ts
    FROM s JOIN a USING ("userId", "productId") WHERE rn = 1""",
)
def _stream_upsert(spark, sf):
    """The older half of the ratings as base, all logged events streamed over it."""
    log, base = _write_log(spark, sf, files=3), run_dir(spark, "stream-upsert")
    ratings = text.stream_rating_log(_stream_session(spark), log, files_per_batch=1)
    start_rating_updates(ratings, f"{base}/updates", f"{base}/checkpoint", available_now=True).awaitTermination()
    older, _ = _base_and_updates(spark, sf)
    return current_ratings(spark, older, f"{base}/updates")


# ---- scalar functions -------------------------------------------------------------------------


@_query("string_hash_id", f"""WITH {U} SELECT username, "userId" FROM u""")
def _string_hash(spark, sf):
    return B.users(spark, sf).select("username", "userId")


@_query("redecode_text", "SELECT doc_id, text, length(text) AS n FROM documents")
def _redecode(spark, sf):
    """UTF-8 text read as Latin-1, brought back."""
    docs = B.table(spark, sf, "documents")
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", sc.redecode_utf8(garbled).alias("text"), F.length("text").cast("bigint").alias("n"))


@_query(
    "epoch_normalise",
    f"""WITH {EV} SELECT "userId", ts, CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INTEGER) AS yearmonth,
    count(*) * 2 AS n FROM ev GROUP BY 1, 2, 3""",
)
def _epoch(spark, sf):
    ratings = B.event_ratings(spark, sf)
    both = ratings.select("userId", F.explode(F.array("ts", F.col("ts") * 1000 + 999)).alias("epoch"))
    seconds = both.select("userId", sc.seconds_of(F.col("epoch")).alias("ts"))
    return (
        seconds.select("userId", "ts", sc.year_month(F.col("ts")).alias("yearmonth"))
        .groupBy("userId", "ts", "yearmonth")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@_query(
    "score_scales",
    f"""WITH {EV} SELECT "userId", "productId", ts, {_HALF} AS stored, {_HALF} * 2 AS shown FROM ev""",
)
def _scores(spark, sf):
    stored = B.event_ratings(spark, sf).select(
        "userId", "productId", "ts", sc.halved_score(F.col("score")).alias("stored")
    )
    return stored.withColumn("shown", sc.star_position(F.col("stored")))


# ---- training-data operators ------------------------------------------------------------------

try:  # the subpackage and the pipeline can be left out together
    import corpus_pipeline
    from shelfsense.llm import queries as llm
except ModuleNotFoundError as missing:
    # or what only they need is not installed
    if missing.name not in ("corpus_pipeline", "shelfsense.llm", "public_tokenizers", "regex", "xxhash", "tiktoken"):
        raise
else:
    _QUERIES.update(llm.QUERIES)
    _ORACLES.update(llm.ORACLES)
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Item-to-item recommendations by co-rating, completed with product details."""
    return _QUERIES["enrich_recs"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
