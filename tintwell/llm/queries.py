"""The registered queries over these operators, and SQL for those that SQL can express."""

from __future__ import annotations

import secrets

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.llm import ann, exact_dedup, langid, packing, piece_codec, pii, quality, sampling, simhash, substring, token_counts

WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"
PII_KEY = "spark.tintwell.pii.key"


def pii_key(spark: SparkSession) -> bytes:
    """The secret of the session, from its setting PII_KEY. Without one, a session draws its own, and nobody can read pseudonyms back after it."""
    if not spark.conf.get(PII_KEY, None):
        spark.conf.set(PII_KEY, secrets.token_hex(32))
    return spark.conf.get(PII_KEY).encode()


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every row of documents, learned from the labels outside the held-out fold."""
    docs = _read(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, _read(spark, sf_dir, "labels")))
    return scored.select("doc_id", sampling.held_out("doc_id").alias("held_out"), "score", "predicted")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every row of embeddings whose id is divisible by 100, among all rows."""
    rows = _read(spark, sf_dir, "embeddings")
    return ann.search(ann.index(rows), rows, F.col("id") % 100 == 0)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document of documents, in sequences of 4096 tokens."""
    return packing.digests(packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE)))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its personal data under pseudonyms."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii_key(spark)).select("doc_id", "text", F.size("pii").alias("n_values"), F.transform("pii", lambda p: p["kind"]).alias("kinds"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with the row of its group that stays."""
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents with its fingerprint and near-duplicate component."""
    return simhash.simhash_groups(_read(spark, sf_dir, "documents")).drop("fp")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text of documents."""
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents without the words of 20-word windows that also start earlier."""
    return substring.digests(substring.remove_repeats(_read(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every row of documents, learned outside the held-out fold."""
    docs = _read(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", sampling.held_out("doc_id").alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropout encoding of every whole text of documents, and the digest of what it decodes to."""
    return piece_codec.encode(_read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), dropout=0.1, seed=0, verify=True)


QUERIES = {f.__name__: f for f in (op1_quality, op2_neighbours, op3_packing, op4_pii, op5_exact_dedup, op6_simhash, op7_token_counts, op8_substring_dedup, op9_language, op10_piece_codec)}

ORACLE_SQL = {
    "op5_exact_dedup": r"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
        g AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                     row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) AS place FROM n)
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
    """,
}
