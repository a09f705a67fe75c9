"""The document pipeline: stages that each apply one operator to what the stage before kept.

Stages take (spark, docs, sf_dir). All but the last return the columns of their
input; rows with nulls in any column go through unless a stage's decision is
about the null itself (a null text has no language).
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable.llm import byte_bpe, contamination, credentials, language, near_dups

#: A text whose most likely language has a smaller posterior is rejected.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts whose language can't be told."""
    model = language.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return language.keep_known(docs, model, LEAST_SCORE)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 or more."""
    return near_dups.keep_one(docs, size=5, part=80, whole=100)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of which a twentieth or more stands in the benchmark."""
    return contamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; n_chars follows the text."""
    return credentials.mask_all(docs, length="n_chars")


def as_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and whether their decoded bytes are the text again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = docs.select("doc_id", "lang", "source", "n_chars", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    keep = ["doc_id", "lang", "source", "n_chars", "text_sha256"]
    found = byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep)
    return found.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", not_in_benchmark),
    ("secrets", no_secrets),
    ("byte_bpe", as_ids),
]
#: SQL can't express language models, MinHash signatures or BPE; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
