"""Bounded samples by hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 60


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text; 0 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 15), 16, 10).cast("long"), F.lit(0))


def within_share(share: Column) -> Column:
    """Hashes in the lowest part of their range."""
    return F.col("hash") <= share * F.lit(float(1 << HASH_BITS))


def one_text(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per ``keys`` with the least of its texts, null only if all are: an id that repeats gives one text, and the
    same one in whatever order rows arrive."""
    return rows.groupBy(*keys).agg(F.min("text").alias("text"))


def least_hashes(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows of distinct ids with the least hashes.

    The count first gives a threshold that about twice as many rows pass, so sorting does not see a top list from every
    task, however many tasks there are.
    """
    share = F.lit(min(1.0, (2 * most + 50) / max(1, rows.count())))
    hashed = rows.withColumn("hash", id_hash(F.col("doc_id"))).where(within_share(share))
    return hashed.orderBy("hash", "doc_id").limit(most).drop("hash")
