"""Line deduplication that can be extended and reversed: exact reference counts, and cuckoo filters over them.

The state is a folder. ``references`` is an exact log of which document holds which line key: inserting documents adds
rows with a count above zero, deleting them adds the same counts below zero, so a sum per key and document is what is
held now. Keys are spread over shards by hash; each shard has two cuckoo filters, one of all keys that are held and one
of those that two or more documents hold. The first tells which keys of an insert may be stored already, so only those
are looked up in the log; the second tells which lines may have to go, so only those are looked up when documents are
cleaned. Filters err on one side only and the log decides every hit, so their errors cost a lookup and change no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import ASCII_SPACE, lists_of, typed
from rosterflow.llm.cuckoo import SLOTS, CuckooFilter
from rosterflow.llm.located import located, locator
from rosterflow.session import stage

LEAST_CHARS = 10
#: buckets of a shard's filter, and the keys at which shards are divided anew (three quarters of its slots)
BUCKETS = 1 << 18
MOST_KEYS = BUCKETS * SLOTS * 3 // 4
#: bytes of filters that are sent to every executor; beyond them lines are looked up in the log without a filter
MOST_SENT = 64 << 20
_SPACE = ASCII_SPACE.encode()
_FILTERS = "shard long, kind string, keys long, cells binary"
KEY = ["hi", "lo"]


def key_of(line: bytes) -> bytes | None:
    """Digest of a line without ASCII white space at its ends and with A-Z lower-cased; None if that is too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < LEAST_CHARS or len(key) < 4 * LEAST_CHARS and len(key.decode("utf-8")) < LEAST_CHARS:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _lines(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    for text in batch.column("text").cast(pa.binary()).to_pylist():
        yield (text or b"").split(b"\n")


def line_keys(docs: DataFrame) -> DataFrame:
    """doc_id, place ``at`` and the distinct keys (two lists of halves) of each row; staged, one pass over the texts."""
    docs = located(docs)
    rows = docs.select("doc_id", "text", locator().alias("at"))
    halves = [T.StructField(h, T.ArrayType(T.LongType())) for h in KEY]
    schema = T.StructType([*typed(rows, "doc_id", "at"), *halves])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, ends = [], [0]
            for lines in _lines(batch):
                found = set(map(key_of, lines))
                found.discard(None)
                digests.extend(sorted(found))
                ends.append(len(digests))
            pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(pairs[:, i])) for i in (0, 1)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("at"), *lists], names=schema.names)

    return stage(rows.mapInArrow(run, schema), "line-keys")


def _exploded(keys: DataFrame, *columns: str) -> DataFrame:
    return keys.select(*columns, F.inline(F.arrays_zip(*KEY)))


@dataclass(frozen=True)
class LineIndex:
    """A state after ``batch`` changes (0: empty), its keys spread over 2 to the power of ``bits`` shards."""

    spark: SparkSession
    folder: str
    batch: int = 0
    bits: int = 0
    id_type: str = "bigint"

    def references(self) -> DataFrame:
        """The log: hi, lo, doc_id, n (document rows holding the key; below zero where deleted)."""
        schema = f"hi long, lo long, doc_id {self.id_type}, n long, batch int"
        if not self.batch:
            return self.spark.createDataFrame([], schema).drop("batch")
        log = self.spark.read.schema(schema).parquet(f"{self.folder}/references")
        return log.where(F.col("batch") <= self.batch).drop("batch")

    def filters(self) -> DataFrame:
        if not self.batch:
            return self.spark.createDataFrame([], _FILTERS)
        return self.spark.read.schema(_FILTERS).parquet(f"{self.folder}/filters/batch={self.batch}")

    def owners(self) -> DataFrame:
        """hi, lo, first (smallest id; null only if no document with an id holds it), docs: keys held by two or more."""
        held = self.references().groupBy(*KEY, "doc_id").agg(F.sum("n").alias("n")).where("n > 0")
        counted = held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first"))
        return counted.where("docs > 1")


def _shard(bits: int) -> Column:
    return F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0).cast("long")


def _changed(index: LineIndex, delta: DataFrame) -> DataFrame:
    """hi, lo and the number of documents that held the key before and hold it after ``delta``."""
    old = index.references()
    if index.batch:
        old = old.join(_maybe_known(index, delta.select(*KEY).distinct()), KEY, "left_semi")
    both = old.withColumn("old", F.col("n")).unionByName(delta.select(*KEY, "doc_id", "n", F.lit(0).cast("long").alias("old")))
    held = both.groupBy(*KEY, "doc_id").agg(F.sum("n").alias("n"), F.sum("old").alias("old"))
    counts = [F.count_if(F.col(c) > 0).alias(name) for c, name in (("old", "before"), ("n", "after"))]
    return stage(held.groupBy(*KEY).agg(*counts), "line-changes")


def _maybe_known(index: LineIndex, keys: DataFrame) -> DataFrame:
    """Keys that their shard's filter of all keys may hold; every stored key is among them."""

    def probe(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return asked[KEY].iloc[:0]
        found = CuckooFilter.from_bytes(held["cells"].iloc[0]).contains(asked["lo"].to_numpy().view(np.uint64))
        return asked.loc[found, KEY]

    asked = keys.withColumn("shard", _shard(index.bits)).groupBy("shard")
    held = index.filters().where("kind = 'all'").groupBy("shard")
    return asked.cogroup(held).applyInPandas(probe, "hi long, lo long")


def _updated(steps: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """A filter after the steps of its shard and kind: adds and removals, in that order."""
    if not len(steps):
        return held[["shard", "kind", "keys", "cells"]]
    known = len(held) > 0
    cuckoo = CuckooFilter.from_bytes(held["cells"].iloc[0]) if known else CuckooFilter(BUCKETS)
    hashes, adds = steps["lo"].to_numpy().view(np.uint64), steps["add"].to_numpy(bool)
    cuckoo.remove(hashes[~adds])
    cuckoo.add(hashes[adds])
    keys = (int(held["keys"].iloc[0]) if known else 0) + int(adds.sum()) - int((~adds).sum())
    head = steps.iloc[0]
    return pd.DataFrame({"shard": [head["shard"]], "kind": [head["kind"]], "keys": [keys], "cells": [cuckoo.to_bytes()]})


def _steps(changes: DataFrame, bits: int) -> DataFrame:
    """Keys that enter or leave a filter: "all" from one document on, "shared" from two on."""
    kinds = []
    for kind, least in (("all", 1), ("shared", 2)):
        was, now = F.col("before") >= least, F.col("after") >= least
        moved = changes.where(was != now)
        kinds.append(moved.select(_shard(bits).alias("shard"), F.lit(kind).alias("kind"), *KEY, now.alias("add")))
    return kinds[0].unionByName(kinds[1])


def _apply(index: LineIndex, delta: DataFrame) -> LineIndex:
    """The state after the counts of ``delta`` (hi, lo, doc_id, n). A batch that failed is written over when run again."""
    spark, number = index.spark, index.batch + 1
    place = f"{index.folder}/references/batch={number}"
    delta.write.mode("overwrite").parquet(place)
    delta = spark.read.schema(delta.schema).parquet(place)
    changes = _changed(index, delta)
    bits, old = index.bits, index.filters()
    added = _steps(changes, bits).where("kind = 'all'").groupBy("shard").agg(F.sum(F.when(F.col("add"), 1).otherwise(-1)).alias("n"))
    sizes = old.where("kind = 'all'").select("shard", F.col("keys").alias("n")).unionByName(added)
    total, fullest = sizes.groupBy("shard").agg(F.sum("n").alias("n")).agg(F.sum("n"), F.max("n")).first()
    if (fullest or 0) > MOST_KEYS:
        # shards are divided: half full on average, and all filters are made anew from the log
        while (total >> bits) > MOST_KEYS // 2:
            bits += 1
        now = LineIndex(spark, index.folder, number, bits, index.id_type)
        held = now.references().groupBy(*KEY, "doc_id").agg(F.sum("n").alias("n")).where("n > 0")
        after = held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("after"))
        changes, old = after.withColumn("before", F.lit(0)), old.where("false")
    by = ["shard", "kind"]
    filters = _steps(changes, bits).groupBy(*by).cogroup(old.groupBy(*by)).applyInPandas(_updated, _FILTERS)
    filters.write.mode("overwrite").parquet(f"{index.folder}/filters/batch={number}")
    return LineIndex(spark, index.folder, number, bits, index.id_type)


def create(spark: SparkSession, folder: str, id_type: str = "bigint") -> LineIndex:
    """An empty state whose files go below ``folder``."""
    return LineIndex(spark, folder, id_type=id_type)


def insert(index: LineIndex, keys: DataFrame) -> LineIndex:
    """The state with further documents, given by their ``line_keys``."""
    held = _exploded(keys, "doc_id").groupBy(*KEY, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return _apply(index, held)


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The state without the documents of the given doc_id; ids that it does not hold change nothing."""
    gone = ids.select(F.col("doc_id").alias("gone")).distinct()
    rows = index.references().join(gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi")
    held = rows.groupBy(*KEY, "doc_id").agg((-F.sum("n")).alias("n")).where("n != 0")
    return _apply(index, held)


def _maybe_shared(index: LineIndex, keys: DataFrame) -> DataFrame:
    """``keys`` with lists cut down to keys that two documents may hold, if the filters are small enough to be sent."""
    held = index.filters().where("kind = 'shared'").select("shard", "cells")
    if (held.agg(F.sum(F.octet_length("cells"))).first()[0] or 0) > MOST_SENT:
        return keys
    cells = {r["shard"]: bytes(r["cells"]) for r in held.collect()}
    sent, bits = index.spark.sparkContext.broadcast(cells), index.bits
    schema = keys.select("doc_id", "at", *KEY).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {shard: CuckooFilter.from_bytes(c) for shard, c in sent.value.items()}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lists = [lists_of(table, h) for h in KEY]
            sizes = np.fromiter(map(len, lists[0]), np.int64, batch.num_rows)
            hi, lo = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in lists)
            hi, lo = hi.astype(np.int64), lo.astype(np.int64)
            shard = (hi.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hi), np.int64)
            found = np.zeros(len(hi), bool)
            for one in np.unique(shard):
                if one in filters:
                    here = shard == one
                    found[here] = filters[one].contains(lo[here].view(np.uint64))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            left = np.bincount(row[found], minlength=batch.num_rows)
            offsets = pa.array(np.concatenate(([0], np.cumsum(left))), pa.int32())
            cut = [pa.ListArray.from_arrays(offsets, pa.array(x[found])) for x in (hi, lo)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("at"), *cut], names=schema.names)

    return keys.mapInArrow(run, schema)


def clean(docs: DataFrame, index: LineIndex, keys: DataFrame | None = None) -> DataFrame:
    """``docs`` without the lines that a document of smaller id holds, and n_lines (before) and n_dropped.

    ``keys``, if at hand, are the ``line_keys`` of the same documents as they are read from files.

    Lines are split at \\n; a null or empty text is one empty line. Lines with keys of fewer than ten code points always
    stay, and so do all lines of a key in the document with the smallest id that ``index`` holds for it. Rows of one id
    are one document. A null id counts as greater than all others, and all null ids as one document. An empty table
    gives no rows. Long texts are split whole, in one task each. All columns are kept, whatever their names;
    ``text`` is the cleaned text, and n_lines and n_dropped take the place of columns of these names.
    """
    given, docs = docs, located(docs)
    if keys is not None and docs is not given:
        raise ValueError("keys name places in files, so they only fit documents read from files")
    keys = line_keys(docs) if keys is None else keys
    asked = _exploded(_maybe_shared(index, keys), "doc_id", "at")
    hits = asked.join(index.owners(), KEY).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    pairs = F.collect_list(F.struct(*KEY))
    gone = hits.groupBy("at").agg(pairs["hi"].alias("_line_hi"), pairs["lo"].alias("_line_lo"))
    gone = gone.withColumnRenamed("at", "_line_at")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.join(gone, locator() == F.col("_line_at"), "left").select(*names, "_line_hi", "_line_lo")
    counts = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped")]
    schema = T.StructType([*typed(docs, *names), *counts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch.select(["_line_hi", "_line_lo"])])
            halves = [table.column(f"_line_{h}").to_pylist() for h in KEY]
            texts, n_lines, n_dropped = [], [], []
            for lines, hi, lo in zip(_lines(batch), *halves):
                kept = lines
                if hi:
                    drop = {d.tobytes() for d in np.array([hi, lo], "<i8").T}
                    kept = [line for line in lines if key_of(line) not in drop]
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            out = {n: batch.column(n) for n in names}
            out["text"] = pa.array(texts, pa.binary()).cast(pa.string())
            columns = [*out.values(), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.record_batch(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
