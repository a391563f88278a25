"""Products similar by their tags: TF-IDF weights and cosine."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.functions.scalars import tags_to_words, words
from shelfsense.functions.vectors import unit
from shelfsense.operators.joins import join_unique
from shelfsense.operators.postings import top_by_terms
from shelfsense.operators.strips import DenseStrip, top_by_product
from shelfsense.shared import settled

# Fixed value: number of hash buckets.
HASH_BUCKETS = 189


def tag_words(products: DataFrame, separator: str | None = "|") -> DataFrame:
    """(productId, words), one row per product. ``separator=None`` takes a tag list as one word.

    Of a product that stands in several rows the least tag list counts.
    """
    tags = F.coalesce(F.col("tags"), F.lit(""))
    unique = products.groupBy(F.col("productId").cast("bigint").alias("productId")).agg(F.min(tags).alias("tags"))
    return unique.select("productId", words(tags_to_words(F.col("tags"), separator)).alias("words"))


def document_frequency(docs: DataFrame) -> DataFrame:
    return (
        docs.select(F.explode(F.array_distinct("words")).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def idf(df, n_docs: int):
    """ln((documents + 1) / (documents with the term + 1))."""
    return F.log((F.lit(n_docs) + 1) / (df + 1))


def tfidf_weights(docs: DataFrame) -> DataFrame:
    """(productId, term, tf, df, weight) over the exact vocabulary."""
    n_docs = docs.count()
    tf = (
        docs.select("productId", F.explode("words").alias("term"))
        .groupBy("productId", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    both = join_unique(tf, document_frequency(docs), "term", apart=["productId"])
    return both.select(
        "productId", "term", "tf", "df", (F.col("tf") * idf(F.col("df"), n_docs)).alias("weight")
    )


def hashed_tfidf(docs: DataFrame, fitted_on: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """(id, vec): TF-IDF over hash buckets, the document frequencies taken from ``fitted_on``."""
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=buckets)
    model = IDF(inputCol="tf", outputCol="tfidf").fit(tf.transform(fitted_on.select("words")))
    return model.transform(tf.transform(docs)).select("id", vector_to_array("tfidf").alias("vec"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Products with the same words in any order share a key, and hence a vector."""
    return docs.where(F.size("words") > 0).select(
        "productId", F.array_join(F.array_sort("words"), " ").alias("key")
    )


def _distinct_vectors(keyed: DataFrame, k: int) -> DataFrame:
    """(key, id, members): per key its smallest id and its k + 1 smallest ids.

    No list can show more than k members of one key besides the product itself, and ties go to
    smaller ids, so the other copies are never needed as partners. The rank filter runs before the
    shuffle too: a key with any share of the products costs no task more than k + 1 rows per input task.
    """
    by_id = Window.partitionBy("key").orderBy("productId")
    return (
        keyed.withColumn("_rn", F.row_number().over(by_id))
        .where(F.col("_rn") <= k + 1)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("productId")).alias("members"))
        .select("key", F.get("members", F.lit(0)).alias("id"), "members")
    )


def _exact_vectors(reps: DataFrame, docs: DataFrame, n_docs: int) -> DataFrame:
    """(id, terms, weights, uses) of length one, rare terms first, ``uses`` being the rows here that have the term.

    A vector of length zero has no similarity and drops out.
    """
    tf = (
        reps.select("id", F.explode(F.split("key", " ")).alias("term"))
        .groupBy("id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    uses = tf.groupBy("term").agg(F.count(F.lit(1)).alias("uses"))
    terms = settled(document_frequency(docs).join(uses, "term"))
    both = join_unique(tf, terms, "term", apart=["id"], counted="uses")
    weighted = both.select("id", "term", "uses", (F.col("tf") * idf(F.col("df"), n_docs)).alias("w"))
    entries = F.array_sort(F.collect_list(F.struct("uses", "term", "w")))
    return (
        weighted.groupBy("id")
        .agg(entries.alias("e"))
        .select("id", F.col("e.term").alias("terms"), unit(F.col("e.w")).alias("weights"), F.col("e.uses").alias("uses"))
        .where("weights IS NOT NULL")
    )


def similar_by_content(
    products: DataFrame,
    k: int = 5,
    separator: str | None = "|",
    hashed: bool = False,
    buckets: int = HASH_BUCKETS,
    include_zero: bool = True,
) -> DataFrame:
    """(productId, rid, r, rank): the ``k`` products of most similar tags for every product.

    Works on distinct tag lists and only then on products. ``include_zero`` lets products without a
    common tag fill up short lists.
    """
    docs = tag_words(products, separator)
    keyed = _keyed(docs)
    reps = settled(_distinct_vectors(keyed, k))
    if hashed:
        raw = hashed_tfidf(reps.select("id", F.split("key", " ").alias("words")), docs, buckets)
        vectors = raw.select("id", unit(F.col("vec")).alias("vec")).where("vec IS NOT NULL")
    else:
        vectors = _exact_vectors(reps, docs, docs.count())
    vectors = settled(vectors)
    n = vectors.count()
    # a key is its own best partner, hence one more than k
    if hashed:
        # few buckets, each in a good share of the rows: an index would part nothing
        best = top_by_product(vectors, vectors, k + 1, ["vec"], DenseStrip, n, n, above=0.0, skip_self=False)
    else:
        best = top_by_terms(vectors, k + 1, n)
    fill = _smallest(vectors, reps, 2 * k + 1) if include_zero else []
    return _for_products(best.where("r > 0"), reps, keyed, k, fill)


def _smallest(vectors: DataFrame, reps: DataFrame, n: int) -> list[int]:
    """The ``n`` smallest products that have a vector: those that a list of zero similarities begins with."""
    members = vectors.select("id").join(reps, "id").select(F.explode("members").alias("id"))
    return [row.id for row in members.orderBy("id").limit(n).collect()]


def _for_products(best: DataFrame, reps: DataFrame, keyed: DataFrame, k: int, fill: list[int]) -> DataFrame:
    """From best keys per key to best products per product; ``fill`` are the products of similarity zero.

    Positive similarities alone go through the joins. Of the at most k products of a list and the product itself
    none is missing from the smallest 2 k + 1 for another reason than standing in the list, so those fill it.
    """
    members = reps.select(F.col("id").alias("rid"), "members")
    ranked = (
        join_unique(best.select("id", "rid", "r"), members, "rid", apart=["id"])
        .select("id", "r", F.explode("members").alias("rid"))
        .withColumn(
            "_rn",
            F.row_number().over(Window.partitionBy("id").orderBy(F.desc("r"), F.asc("rid"))),
        )
        .where(F.col("_rn") <= k + 1)
    )
    lists = ranked.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("_rn", "rid", "r"))).alias("recs"))
    by_key = reps.select("id", "key").join(lists, "id").select("key", "recs")
    others = F.expr("transform(filter(recs, x -> x.rid <> productId), x -> struct(x.rid AS rid, x.r AS r))")
    zeros = F.array(*[F.struct(F.lit(x).cast("bigint").alias("rid"), F.lit(0.0).alias("r")) for x in fill])
    if fill:
        listed = F.transform("recs", lambda x: x["rid"])
        left = F.filter(zeros, lambda x: (x["rid"] != F.col("productId")) & ~F.array_contains(listed, x["rid"]))
        others = F.concat(others, left)
    own = join_unique(keyed, by_key, "key", apart=["productId"]).select(
        "productId", F.slice(others, 1, k).alias("recs")
    )
    return own.select("productId", F.posexplode("recs").alias("pos", "rec")).select(
        "productId",
        F.col("rec.rid").alias("rid"),
        F.col("rec.r").alias("r"),
        (F.col("pos") + 1).alias("rank"),
    )
