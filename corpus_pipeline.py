"""A corpus, from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last keep the columns of docs.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrid.llm import langid, minhash, mixing, pieces, suffixes
from skygrid.llm.common import removed, scratch, shared_dir, table

#: The stages hold models and union-find, which SQL doesn't express; tests hold run() against brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return langid.accepted(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return minhash.one_of_each(docs, percent=80, width=5)


def repeats_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has are cut out; every document stays."""
    cut = suffixes.without_repeats(docs, width=50)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mixed_rows(docs, weights=(3, 1, 2), share=1.5, max_epochs=2)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, exact: the corpus as token ids."""
    return pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_near_copies),
    ("repeated_passages", repeats_removed),
    ("mixing", mixed),
    ("sentence_pieces", sentence_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the shared folder, and goes when the next stage is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/corpus-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
