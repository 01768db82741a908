"""A training corpus from raw documents: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rosterflow.llm import exact_dedup, mixing, packing, quality, simhash
from rosterflow.session import stage


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get texts in batches of at most 8 MB, since they stay alive from stage to stage."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality vote does not reject; null and empty texts score as the labelled sample's share of
    good ones. Repeated rows are judged each for itself, and an empty table stays empty."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels, quality.train_rows()), least=0.3)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the smallest id, a null id last, then the first row.
    Null and empty texts are one group."""
    bounded_batches(spark)
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close fingerprints: the smallest id, a null id last, then the first row. Texts
    without words are linked with each other."""
    bounded_batches(spark)
    return simhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: left out, once or twice. A null source is one of the sources;
    rows of equal id are taken alike."""
    bounded_batches(spark)
    return mixing.mixed_rows(docs, [5, 2, 1], 1.5)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their ids. A null or empty text is its end token."""
    bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=100_000)


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", without_copies),
    ("near_duplicates", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: trained models, streamed state and a tokenizer are beyond SQL; tests compare the stages with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
