"""From raw documents to token ids: the stages of the corpus pipeline, each one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.llm import bpe, mixing, quality, simhash, substrings
from shelfsense.llm.queries import VOCABULARY
from shelfsense.shared import run_dir


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold, ranked by the labels that are not held out.

    A null text is scored as an empty one. Rows are judged one by one, so repeated ones and those of null id share a fate.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out())
    ranking = quality.learn(docs, labels)
    return docs.where(ranking.score(F.col("text")) >= quality.CUT)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of 3 words, fingerprints within 3 bits.

    The smallest id of a group stays. Null and empty texts have a fingerprint of zeros and are one group.
    """
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word passages that stand earlier; a text that loses all its words goes.

    Texts that lose nothing stay as they are, those that do hold the other words joined by one space. A null or empty
    text has no words and stays. Other columns come through, also under the names that the operator uses itself.
    """
    own = {c: f"_own_{c}" for c in docs.columns if c in ("n_words", "n_removed", "kept", "bucket")}
    found = substrings.remove_repeats(docs.withColumnsRenamed(own)).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    length = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("n_chars"))
    changed = found.withColumns({"text": text, "n_chars": length.cast("bigint")})
    return changed.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, the last one of a source cut to what was left to take."""
    rows = mixing.repeated(docs)
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row; a document that the mix repeats is encoded as often."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", one_of_each),
    ("substring dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

#: Scores, fingerprints and token ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = run_dir(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
