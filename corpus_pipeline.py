"""From raw documents to token ids in five stages, each one of the operators in ``partyfold.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its
result is written as Parquet and read again. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partyfold.llm import bpe, jaccard_join, language, mixing, secrets
from partyfold.llm.common import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.recognised(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, n=5, num=80, den=100)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced; n_chars follows the text."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and whether the ids decode to the text."""
    return bpe.encoded_and_checked(docs, *bpe.vocabulary(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", without_near_copies),
    ("secret_scan", without_secrets),
    ("source_mix", mixed),
    ("byte_bpe", as_tokens),
]

#: SQL cannot express the naive Bayes stage, the test battery or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
