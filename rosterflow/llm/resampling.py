"""Importance resampling towards a target corpus.

Runs of one or two words are hashed into buckets. A bucket's gain is the log ratio of its share in the target and in the
documents; gains stand in one array, so a document's weight is a mean of array entries. With a Gumbel number per id
added, the documents of highest scores are a draw without replacement; ranks come from a distributed radix sort.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm import radix
from rosterflow.llm.common import typed
from rosterflow.session import stage

BUCKETS = 10_000
#: bytes of a text whose words are held at once
PIECE = 1 << 20
#: buckets that are counted at once
_TOGETHER = 1 << 20
#: A-Z in lower case, digits, a-z and bytes of other letters as they are, all else blank
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BLANK = np.array([crc32(b" ", s) ^ crc32(b" ", 0) for s in range(256)], np.uint32)


def _after_blank(crcs: np.ndarray) -> np.ndarray:
    """CRCs of strings when a blank follows them."""
    return _BLANK[crcs & np.uint32(255)] ^ crcs >> np.uint32(8) ^ np.uint32(crc32(b" ", 0))


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in order, in lists of about PIECE bytes."""
    plain = text.translate(_LETTERS)
    at = 0
    while at < len(plain):
        end = at + PIECE
        if end < len(plain):
            end = plain.find(b" ", end)
            end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def features(text: bytes, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, int]]:
    """(buckets of the words and of the pairs of neighbours, words) of a text, piece by piece."""
    last = None
    for words in word_pieces(text):
        if not words:
            continue
        singles = np.fromiter(map(crc32, words), np.uint32, len(words))
        before = singles[:-1] if last is None else np.concatenate(([last], singles[:-1]))
        second = words[1:] if last is None else words
        pairs = np.fromiter(map(crc32, second, _after_blank(before).tolist()), np.uint32, len(second))
        last = singles[-1]
        yield np.concatenate((singles, pairs)) % np.uint32(buckets), len(words)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; each task sends at most one row per bucket, the driver gets one per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, size = np.zeros(buckets, np.int64), [], 0
        for batch in batches:
            for text in _texts(batch):
                for found, _ in features(text, buckets):
                    waiting.append(found)
                    size += len(found)
                    if size >= _TOGETHER:
                        total += np.bincount(np.concatenate(waiting), minlength=buckets)
                        waiting, size = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = docs.select("text").mapInArrow(run, "bucket long, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of each bucket's smoothed shares."""
    size, goal, n = float(docs.sum()), float(target.sum()), float(len(docs))
    ratio = [(t + 1.0) * (size + n) / ((s + 1.0) * (goal + n)) for s, t in zip(docs.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of a digest of seed and id (a null id is an empty text)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 7) -> DataFrame:
    """Every row without its text, and n_words, n_features, weight (floored mean gain, 0 without words), score."""
    others = [c for c in docs.columns if c != "text"]
    added = ["n_words", "n_features", "weight", "score"]
    schema = T.StructType([*typed(docs, *others), *[T.StructField(c, T.LongType()) for c in added]])
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch)):
                words = count = total = 0
                for found, n in features(text, len(gain)):
                    words, count, total = words + n, count + len(found), total + int(gain[found].sum())
                weight = total // count if count else 0
                rows.append((words, count, weight, weight + gumbel(doc_id, seed)))
            table = np.array(rows, np.int64).reshape(-1, len(added))
            columns = [*(batch.column(c) for c in others), *(pa.array(table[:, i]) for i in range(len(added)))]
            yield pa.record_batch(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``; rank is null where a row is not drawn.

    Of the rows with ``least_words`` words the ``percent`` hundredths (floored) of highest score are drawn; equal scores
    go to the smaller id, a null id comes last, and rows of equal id and score stand by n_features, then as they were
    read. A null or empty text has no features and weight 0. Rows may repeat; each is a document of its own. Texts are
    read whole, a piece of a megabyte at a time. An empty target or table is no error: counts are then zero. Further
    columns of either table are not looked at.
    """
    rows = docs.select("doc_id", "text")
    gain = gains(bucket_counts(rows, buckets), bucket_counts(target, buckets))
    weighed = stage(scored(rows, gain, seed), "weighed")
    enough = F.col("n_words") >= least_words
    unnamed = F.col("doc_id").isNull().cast("long")
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    keys = [radix.ordered(F.col("score"), True), radix.ordered(unnamed), radix.ordered(number), radix.ordered(F.col("n_features"))]
    running = stage(weighed.where(enough), "resample")
    sorted_rows = radix.radix_places(running, keys, "_place")
    drawn = running.count() * percent // 100
    rank = F.when(F.col("_place") < drawn, F.col("_place") + 1)
    others = weighed.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    ranked = sorted_rows.withColumn("rank", rank).drop("_place").unionByName(others)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")
