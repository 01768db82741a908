"""Toxicity by cumulative-link ordinal regression on sparse word features.

One weight per word is shared by all thresholds: P(grade > k) = sigmoid(w x - threshold_k) with thresholds in ascending
order. The expected severity is the sum of these probabilities, between 0 and the highest grade.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import lists_of, texts_of, typed
from rosterflow.llm.sampling import least_hashes, one_text

BUCKETS = 1 << 20
#: labelled documents of each label that a fit may use, those with the least id hashes
MOST_PER_LABEL = 2000
#: a word is a feature if at least this many sample documents hold it
LEAST_DOCS = 5
#: lengths of the beginnings of words that are features beside the words
PREFIXES = (4, 5, 6)
#: weight of the absolute values in the loss
PENALTY = 5e-4
#: a text is toxic if a grade above 0 has at least this probability
LEAST = 0.3
REMEMBERED, LONGEST = 400_000, 64
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter:
    """Lower-case runs of letters and how often each occurs."""
    return Counter(_WORD.findall(text.lower()))


def buckets_of(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings, which inflected or joined forms share."""
    parts = [word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]
    return [crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers in ascending order and how often each occurs."""
    counts = words_of(text)
    pairs = [(b, c) for w, c in counts.items() for b in buckets_of(w)]
    numbers, place = np.unique(np.array([b for b, _ in pairs], np.int64), return_inverse=True)
    return numbers, np.bincount(place, [c for _, c in pairs], len(numbers)).astype(np.int64)


@dataclass
class Model:
    """weight by bucket (words without weight are not in it), thresholds in ascending order."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def above(self, values: np.ndarray) -> np.ndarray:
        """P(grade > k) for each linear value and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - values[:, None], -500, 500)))


class _Weights(dict):
    """Weighted features of words, remembered for at most REMEMBERED of them."""

    def __init__(self, model: Model):
        super().__init__()
        self.weights = model.weights

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(b for b in buckets_of(word) if b in self.weights)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def value(self, text: str) -> float:
        """w x of a text: each feature counts with the logarithm of its occurrences."""
        counts = Counter()
        for word, c in words_of(text).items():
            for b in self[word]:
                counts[b] += c
        return sum(self.weights[b] * math.log2(1 + counts[b]) for b in sorted(counts))


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, grade: str | None = None, grades: int = 3) -> Model:
    """Learns from at most MOST_PER_LABEL documents with ``toxic`` 1 and as many with 0 among ``train`` rows.

    ``grade``: a column of labels with ordered grades 0, 1, 2, ...; without one, grade 0 are documents that are not
    toxic and toxic ones are spread over 1 to ``grades`` by how many of their words mark toxic documents, in equal
    parts. Rows without id or label are left out; the greatest of several labels counts. Words of whole texts are made
    in tasks; the driver gets the word numbers of one row per id of the sample, the least of its texts. Copies in the sample
    count once. Each document of the sample
    weighs as many train rows of its label as it stands for, so probabilities do not hang on the size of the table.
    """
    kind = F.col("toxic").cast("int")
    level = F.col(grade).cast("int") if grade else kind
    rows = labels.where(F.col("doc_id").isNotNull() & kind.isNotNull() & level.isNotNull())
    rows = rows.where(train) if train is not None else rows
    rows = rows.groupBy("doc_id").agg(F.max(kind).alias("toxic"), F.max(level).alias("grade"))
    sample = least_hashes(rows.where("toxic > 0"), MOST_PER_LABEL)
    sample = sample.unionByName(least_hashes(rows.where("toxic <= 0"), MOST_PER_LABEL))
    kinds = rows.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("rows")).collect()
    stands_for = {r["toxic"]: r["rows"] / min(r["rows"], MOST_PER_LABEL) for r in kinds}
    bag = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("grade", T.IntegerType()),
            T.StructField("toxic", T.IntegerType()),
            T.StructField("buckets", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches):
            bags = [features(t) for t in texts]
            lists = [pa.array([b[i] for b in bags], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.record_batch([*map(batch.column, ("doc_id", "grade", "toxic")), *lists], names=bag.names)

    texts = one_text(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "doc_id", "grade", "toxic")
    found = texts.mapInArrow(run, bag).toArrow().sort_by("doc_id")
    different, grade_of = {}, found.column("grade").to_pylist()
    for i, (numbers, counts) in enumerate(zip(lists_of(found, "buckets"), lists_of(found, "counts"))):
        different.setdefault((numbers.tobytes(), counts.tobytes()), (i, numbers, counts))
    kept = list(different.values())
    label_of = found.column("toxic").to_pylist()
    share = np.array([stands_for[label_of[k[0]] > 0] for k in kept])
    return _fitted([k[1:] for k in kept], np.array([grade_of[k[0]] for k in kept], np.int64), None if grade else grades, share)


def _select(bags: list, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets whose documents are toxic clearly more or less often than the rest, and the size of the difference."""
    n1, n0 = max(1, toxic.sum()), max(1, (~toxic).sum())
    with_word = [np.bincount(np.concatenate([b[0] for b, t in zip(bags, toxic) if t == k] or [np.zeros(0, np.int64)]).astype(np.int64), minlength=BUCKETS) for k in (True, False)]
    p1, p0 = with_word[0] / n1, with_word[1] / n0
    pooled = (with_word[0] + with_word[1] + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    kept = np.flatnonzero((with_word[0] + with_word[1] >= LEAST_DOCS) & (np.abs(z) > 3.5))
    kept = kept[np.argsort(-np.abs(z[kept]), kind="stable")][:500]
    return kept, z[kept]


def _fitted(bags: list, grade: np.ndarray, spread: int | None, share: np.ndarray, steps: int = 1500, rate: float = 0.05) -> Model:
    """Proximal gradient steps with momentum from zero: small weights vanish, thresholds stay in order."""
    toxic = grade > 0
    if not len(bags) or toxic.all() or not toxic.any():
        return Model({}, np.full(max(1, spread or 1), 50.0 if not toxic.any() else -50.0))
    kept, strength = _select(bags, toxic)
    slot = np.full(BUCKETS, -1)
    slot[kept] = np.arange(len(kept))
    x = np.zeros((len(bags), len(kept)))
    for i, (numbers, counts) in enumerate(bags):
        place = slot[numbers]
        x[i, place[place >= 0]] = np.log2(1 + counts[place >= 0])
    if spread:
        marks = (x[:, strength > 0] > 0).sum(axis=1)[toxic]
        place = np.empty(len(marks), np.int64)
        place[np.argsort(marks, kind="stable")] = np.arange(len(marks)) * spread // len(marks)
        grade = grade.copy()
        grade[toxic] = 1 + place
    top = int(grade.max())
    over = (grade[:, None] > np.arange(top)).astype(float)
    weights, thresholds = np.zeros(len(kept)), np.linspace(0, 1, top)
    speed, drift = np.zeros_like(weights), np.zeros(top)
    share = (share / share.sum())[:, None]
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(thresholds - (x @ weights)[:, None], -500, 500)))
        slope = (p - over) * share
        speed = 0.9 * speed - rate * (x.T @ slope.sum(axis=1))
        drift = 0.9 * drift + rate * slope.sum(axis=0)
        weights = np.sign(weights + speed) * np.maximum(np.abs(weights + speed) - rate * PENALTY, 0)
        thresholds = np.maximum.accumulate(thresholds + drift)
    return Model({int(b): float(w) for b, w in zip(kept, weights) if w}, thresholds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), grade (its median) and toxic (has a grade above 0 probability LEAST?) of
    every row.

    A null or empty text, or one without known words, is judged by the thresholds alone; without toxic documents to
    learn from all severities are about 0. Equal texts score alike; rows may repeat; further columns are not looked at.
    """
    schema = T.StructType(
        [
            *typed(docs, "doc_id"),
            T.StructField("severity", T.DoubleType()),
            T.StructField("grade", T.IntegerType()),
            T.StructField("toxic", T.BooleanType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = _Weights(shared.value)
        for batch, texts in texts_of(batches):
            values = np.array([weigh.value(t) for t in texts], float)
            above = shared.value.above(values)
            grade = (above >= 0.5).sum(axis=1)
            columns = [pa.array(above.sum(axis=1)), pa.array(grade, pa.int32()), pa.array(above[:, 0] >= LEAST)]
            yield pa.record_batch([batch.column("doc_id"), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
