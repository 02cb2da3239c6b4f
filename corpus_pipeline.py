"""Corpus pipeline: documents to token ids.

Language identification rejects documents without a language; exact and near
duplicates leave one document of each group; documents that hold benchmark items go; the
rest is encoded. Each stage takes all documents that the stage before it kept, with all
their columns, and is written as Parquet before the next one reads it.

Defined results: null and empty texts have no language and go in the first stage. Rows
that repeat id and text count once, texts that share an id are told apart by their
content, and a null id is an id like others. Extra columns pass through untouched,
whatever their names; empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import bpe, decontaminate, exact_dedup, language_id, near_dedup
from ticklake.llm.common import staged, table


def _content() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language. The score is no measure of that: among languages
    that fit a short text equally well, it is split. All labelled documents are learned from;
    nothing is measured here that some would have to be held out for."""
    model = language_id.learn(docs)
    found = _unused(docs, "language_found")
    return (
        docs.withColumn(found, language_id.predictor(language_id.share(docs, model), F.col("text")))
        .filter(F.col(found)["lang_pred"] != language_id.UNDETERMINED)
        .drop(found)
    )


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id."""
    key = _unused(docs, "content")
    kept = exact_dedup.exact_groups(docs).filter("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_content")
    )
    rows = docs.withColumn(key, _content())
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col(key) == F.col("kept_content"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles."""
    key = _unused(docs, "row_key")
    # of rows that share an id, the hash tells the texts apart; few bytes, as each row has many
    content = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.withColumn(key, F.struct(F.col("doc_id").alias("doc_id"), content.alias("content")))
    near = near_dedup.near_duplicates(rows.select(key, "text"), id_col=key)
    return rows.join(near.filter("NOT kept").select(key), key, "left_anti").drop(key)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    key = _unused(docs, "content")
    rows = docs.withColumn(key, _content())
    hits = decontaminate.contaminated(rows.select(key, "text"), table(spark, sf_dir, "benchmark"), id_col=key)
    return rows.join(hits.select(key).distinct(), key, "left_anti").drop(key)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return docs.select("doc_id", bpe.encoded(F.col("text"), path).alias("ids")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids"
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

#: Parsing, near links and latent retrieval are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        if place:
            docs = staged(docs, f"before-{name}")
        docs = stage(spark, docs, sf_dir)
    return docs
