"""Exact deduplication as a stream with keyed state on disk.

Per row only a digest, its id, its length and a content locator (file and row) move. A streaming aggregation keeps, for
each digest and without expiry, the row that stays and the number of rows; its state lives in RocksDB and is saved in
the shared checkpoint folder, so later files of the same corpus continue it. Rows that hit a known digest are compared
with the bytes of the row that stays, read through the locator; digests shared by different texts are split by text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.located import located, locator, without
from rosterflow.session import checkpoint_root, stage

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: bound on RocksDB's memory per executor, so that state grows on disk and not in memory
ROCKS_CONF = {
    PROVIDER: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # with many small partitions, files claimed in advance would take more than the state itself
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _rank() -> Column:
    """Orders the rows of a group; the greatest stays: most code points, then smallest id, a null id last."""
    return F.struct("points", F.col("doc_id").isNotNull().alias("named"), F.bitwise_not("doc_id").alias("turned"), "at")


def update_state(spark: SparkSession, rows: str, schema, work: str, files_per_batch: int | None = None) -> DataFrame:
    """Feeds the files of ``rows`` that the state in ``work`` has not seen; returns (key, best, size) of all keys.

    Every batch writes the groups that it changed; rank and count only grow, so the last values are the greatest.
    """
    before = {k: spark.conf.get(k, None) for k in ROCKS_CONF}
    for k, v in ROCKS_CONF.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        groups = reader.parquet(rows).groupBy("key").agg(F.max(_rank()).alias("best"), F.count(F.lit(1)).alias("size"))
        shape = groups.schema

        def save(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{work}/groups/batch={number}")

        writer = groups.writeStream.outputMode("update").option("checkpointLocation", f"{work}/state")
        writer.trigger(availableNow=True).foreachBatch(save).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changed = spark.read.schema(shape).parquet(f"{work}/groups")
    return changed.groupBy("key").agg(F.max("best").alias("best"), F.max("size").alias("size"))


def exact_duplicates(
    docs: DataFrame, key: Callable[[Column], Column] = lambda digest: digest, work: str | None = None
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and the locator ``at`` (file, row) of every row.

    Texts are equal when the same after white space is deleted; a null text is empty. The row with the most code points
    stays, then the smallest id (a null id comes last), then the later place among equal rows, so one row of each group
    stays even if whole rows repeat. ``key`` maps the digest to the state's key; texts that share a key by chance are
    told apart by their bytes. An empty table gives no rows. Ids are integers; further columns are not looked at.
    """
    spark, docs = docs.sparkSession, located(docs)
    work = work or f"{checkpoint_root(spark)}/dedup-{uuid.uuid4().hex}"
    content = normalised(F.col("text"))
    points = F.coalesce(F.char_length("text"), F.lit(0)).alias("points")
    sha = F.sha2(content, 256)
    rows = docs.select("doc_id", points, sha.alias("text_sha256"), locator().alias("at"))
    rows = rows.select("*", key(F.col("text_sha256")).alias("key"))
    rows.write.parquet(f"{work}/rows/{uuid.uuid4().hex}")
    schema = rows.schema
    rows = spark.read.schema(schema).parquet(f"{work}/rows/*")
    groups = stage(update_state(spark, f"{work}/rows/*", schema, work), "dedup-groups")

    hits = groups.where("size > 1").select("key", F.col("best.at").alias("first"))
    texts = docs.select(key(sha).alias("key"), content.alias("content"), points, "doc_id", locator().alias("at"))
    hit_texts = stage(texts.join(hits, "key"), "dedup-hits")
    first = hit_texts.where("at = first").select(F.col("key").alias("k"), F.col("content").alias("known"))
    others = hit_texts.where("at != first")
    differ = others.join(first, (F.col("key") == F.col("k")) & (F.col("content") != F.col("known")))
    # written right behind the join, which can then be split where one text has many copies
    shared = stage(differ.select("key"), "dedup-differ").distinct()

    size = F.col("size")
    found = rows.join(groups, "key").select("doc_id", "text_sha256", "key", "at", "best", size.alias("group_size"))
    if not shared.isEmpty():
        apart = hit_texts.join(shared, "key", "left_semi")
        exact = apart.groupBy("key", "content").agg(F.max(_rank()).alias("own"), F.count(F.lit(1)).alias("own_size"))
        told = apart.join(exact, ["key", "content"]).select(F.col("at").alias("place"), "own", "own_size")
        found = found.join(told, F.col("at") == F.col("place"), "left").select(
            "doc_id",
            "text_sha256",
            "at",
            F.coalesce("own", "best").alias("best"),
            F.coalesce("own_size", "group_size").alias("group_size"),
        )
    kept = F.col("at") == F.col("best.at")
    keep_id = F.bitwise_not("best.turned")
    return found.select(
        "doc_id", keep_id.alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "at"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = located(docs)
    return without(docs, exact_duplicates(docs).where("NOT kept").select("at"))
