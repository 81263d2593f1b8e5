"""Corpus preparation in five stages: quality, exact copies, near copies, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.llm import exact_dedup, jaccard, packing, pii, quality, simhash
from tintwell.llm.queries import WORD_BPE, pii_key
from tintwell.operators.graph import components
from tintwell.operators.scratch import drop, scope, staged


def _beside(docs: DataFrame, *made: str) -> tuple[DataFrame, list[Column]]:
    """docs with columns named like one that an operator adds under other names, and what brings back the columns of docs."""
    aside = {c: f"_own_{k}" for k, c in enumerate(docs.columns) if c.lower() in made}
    return docs.withColumnsRenamed(aside), [F.col(aside.get(c, c)).alias(c) for c in docs.columns]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality vote accepts; labels come from the labels table of sf_dir.

    A null or empty text is voted on as the empty text; rows without an id and repeated rows are each voted on. Where
    nothing can be learned, every score is 0.5 and all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, own = _beside(docs, "score", "predicted")
    return quality.score(rows, quality.fit(docs, labels)).where("predicted = 1").select(*own)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of equal texts.

    Null, empty and blank texts are one group each of the empty text and of one space. A null id is behind every other
    id; of repeated rows one stays.
    """
    rows, own = _beside(docs, "keep_id", "group_size", "kept", "text_sha256")
    return exact_dedup.exact_dedup(rows).where("kept").select(*own)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of near copies; rows without an id stay.

    Linked are close fingerprints (operator 6) and texts with a Jaccard similarity of at least 0.8 of five-word shingles.
    """
    groups = simhash.simhash_groups(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    roots = components(groups.unionByName(jaccard.links(docs)))
    gone = roots.where("node <> root").select(F.col("node").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data under pseudonyms of the session's key and n_chars following the text; a null text stays null."""
    rows, own = _beside(docs, "pii")
    done = pii.pseudonymise(rows, pii_key(spark))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.size("pii") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return done.select(*own)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document, in pieces of sequences of 4096; a null or empty text is its end alone, repeated rows are each packed."""
    pieces = packing.pack(docs, public_tokenizers.path(WORD_BPE))
    return pieces.withColumn("ids_crc32", F.crc32("token_ids"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("simhash near-dedup", without_near_copies),
    ("pii", pseudonymised),
    ("packing", packed),
]

#: The quality vote and the tokenizer have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next one; what no later stage reads is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before = docs
        with scope() as written:
            docs = staged(stage(spark, before, sf_dir), f"stage-{k}")
        for table in [before, *written[:-1]]:
            drop(table)
    return STAGES[-1][1](spark, docs, sf_dir)
