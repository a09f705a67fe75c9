"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable import session
from seqtable.llm import (
    alignment,
    bitslices,
    byte_bpe,
    contamination,
    conversations,
    credentials,
    language,
    licences,
    near_dups,
    neighbours,
    quality,
    token_counts,
    token_files,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors found of each vector whose id is divisible by 100."""
    return neighbours.search(table(spark, folder, "embeddings"), every=100, k=10)


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents written to coded files in order of doc_id, and what is read back from them."""
    files = session.new_folder(spark, "tokens")
    token_files.write(table(spark, folder, "documents"), files, public_tokenizers.path("word_bpe_49k.json"), end=2)
    found = token_files.read(spark, files, token_files.checksum, "ids_crc32 bigint")
    return found.withColumnRenamed("key", "doc_id")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, learned from labels whose checksum leaves another remainder than 1."""
    documents, held_out = table(spark, folder, "documents"), language.held_out(F.col("doc_id"), 3, 1)
    network = quality.fit(documents, table(spark, folder, "labels").filter(~held_out))
    found = quality.score(documents, network, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Known licences and notices in all documents."""
    return licences.scan(table(spark, folder, "documents"), "doc_id")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents under a unigram model over a public vocabulary."""
    return token_counts.count(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learned from those whose checksum leaves another remainder than 0."""
    documents = table(spark, folder, "documents")
    held_out = language.held_out(F.col("doc_id"), 5, 0)
    model = language.fit(documents.filter(~held_out), public_tokenizers.path("piece_bpe_32k.model"))
    found = language.predict(documents, model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents that stand in 13-word windows of the benchmark."""
    found = contamination.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])
    hits, items = F.col("hits"), F.col("items")
    return found.select(
        "doc_id",
        "n_words",
        contamination.n_hit(hits).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        contamination.contaminated(hits, F.col("n_words")).alias("contaminated"),
    )


OP7_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM benchmark
), wins AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i + 1:i + 13], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
), dw AS (
    SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM d, (SELECT DISTINCT n FROM wins))
), hits AS (
    SELECT doc_id, item_id, i, n FROM dw JOIN wins USING (n, win)
), n_hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), n_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n_hits USING (doc_id) LEFT JOIN n_items USING (doc_id)
"""


def op8_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles have a similarity of 0.85 or more."""
    found = near_dups.groups(table(spark, folder, "documents"), size=3, part=85, whole=100)
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", same.alias("kept"))


OP8_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^ \t\n\x0B\f\r]+'), []) AS w
    FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 3], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a, b
    FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL) l
    JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * l.n >= 85 * (p.n + q.n - l.n)
), reach AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION
    SELECT doc_id, b FROM reach JOIN links ON a = other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents: counts and digest of the base spans, and the list of all spans."""
    found = credentials.scan(table(spark, folder, "documents"), ["doc_id"])
    spans, of_kind = F.col("spans"), credentials.of_kind
    return found.select(
        "doc_id",
        *[F.size(of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in credentials.BASE],
        F.sha2(credentials.listed(of_kind(spans, *credentials.BASE)), 256).alias("base_sha256"),
        credentials.listed(spans).alias("spans"),
    )


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE of all documents: number of tokens, digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = byte_bpe.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN, ["doc_id"])
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of all conversations after repeatable damage, their cheapest repair and a digest of the result."""
    damaged = conversations.damage(table(spark, folder, "conversations"))
    return conversations.audits(damaged)


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Links between the tokens of two tokenizers in all documents, weighed by how usual they are in the corpus."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    written = session.new_folder(spark, "aligned")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    sums = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256"]
    found = alignment.align(table(spark, folder, "documents"), *paths, ["doc_id"])
    found.select("*", digest).drop("groups").write.parquet(f"{written}/documents")
    aligned = spark.read.parquet(f"{written}/documents")
    alignment.pair_counts(aligned).write.parquet(f"{written}/pairs")
    weighed = alignment.weigh(aligned, spark.read.parquet(f"{written}/pairs"), sums)
    return weighed.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")


def op13_top_products(spark: SparkSession, folder: str) -> DataFrame:
    """The five highest integer inner products of each vector whose id is divisible by 50."""
    return bitslices.search(table(spark, folder, "embeddings"), every=50, k=5)


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_token_files": op2_token_files,
    "op3_quality": op3_quality,
    "op4_licences": op4_licences,
    "op5_token_counts": op5_token_counts,
    "op6_language": op6_language,
    "op7_contamination": op7_contamination,
    "op8_near_dups": op8_near_dups,
    "op9_secrets": op9_secrets,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_conversations": op11_conversations,
    "op12_alignment": op12_alignment,
    "op13_top_products": op13_top_products,
}
ORACLES: dict[str, str] = {
    "op7_contamination": OP7_SQL,
    "op8_near_dups": OP8_SQL,
}
