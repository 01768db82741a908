"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a bag of hashed words, word shapes and repeats. Latent vectors come from a truncated singular value
decomposition of a bounded labelled sample; its vectors (at most ``most`` rows of ``rank`` numbers) are broadcast. Every
document is projected, its cosines with all labelled vectors are computed exactly, block by block, and the nearest
neighbours vote with their similarity as weight.
"""

from __future__ import annotations

import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import held_out, lists_of, texts_of, typed
from rosterflow.llm.sampling import least_hashes, one_text

#: hashed words and, after them, hashed shapes and repeats
WORDS, SHAPES = 1 << 15, 1 << 12
#: shares of repeated neighbouring words and of repeated lines above which a feature of its own has that share
LEVELS = (0, 0.05, 0.2)
REPEATS = WORDS + SHAPES - 2 * len(LEVELS)
#: what words count beside shapes and repeats, which say more about form
WORD_WEIGHT = 0.4
#: labelled rows that a fit may use, the least hashes of their ids
MOST_LABELLED = 3000
#: features that a fit may use, the most frequent ones, each in at least LEAST_DOCS labelled documents
MOST_FEATURES, LEAST_DOCS = 6000, 3
RANK, NEIGHBOURS, BLOCK = 64, 15, 512
PRIOR_WEIGHT = 0.05
REMEMBERED = 100_000
#: classes of a stretch of a word's shape; letters beyond which a word counts by stretches, and letters of these
SHAPE, LONG, GRAM = 12, 32, 5

_RUN = re.compile(r"(.)\1+", re.S)
_WORD = re.compile(r"[^\W\d_]+")
_KNOWN: dict[str, tuple[int, int]] = {}


def _shapes(word: str) -> list[str]:
    """Letters as a or A, digits as 0, other characters as they are, runs as one: all stretches of SHAPE of them."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    kinds = _RUN.sub(r"\1", kinds)
    return [kinds[i : i + SHAPE] for i in range(max(1, len(kinds) - SHAPE + 1))]


def _grams(word: str) -> list[str]:
    """The letters of a word; of a long one all stretches of GRAM letters."""
    letters = "".join(_WORD.findall(word.lower()))
    if len(letters) <= LONG:
        return [letters]
    return [letters[i : i + GRAM] for i in range(len(letters) - GRAM + 1)]


def _hashes(pieces: list[str]) -> np.ndarray:
    return np.array([crc32(p.encode("utf-8", "replace")) for p in pieces], np.int64)


def _slots(word: str) -> tuple[int, int]:
    """Numbers of a word of one stretch each."""
    found = _KNOWN.get(word)
    if found is None:
        own, shape = _hashes([_grams(word)[0], _shapes(word)[0]]).tolist()
        found = own % WORDS, WORDS + shape % (REPEATS - WORDS)
        if len(_KNOWN) >= REMEMBERED:
            _KNOWN.clear()
        _KNOWN[word] = found
    return found


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and the share of each among words or lines; both empty for a text without words.

    A word that is long, as texts without blanks are, shares its weight among all its stretches, so that every character
    counts.
    """
    words = text.split()
    counts = Counter(words)
    long = [w for w in counts if len(w) > SHAPE and (len(w) > LONG or len(_shapes(w)) > 1)]
    again = sum(map(operator.eq, words, islice(words, 1, None)))
    numbers, weights = [], []
    for word in long:
        often = counts.pop(word)
        for found in (_hashes(_grams(word)) % WORDS, WORDS + _hashes(_shapes(word)) % (REPEATS - WORDS)):
            numbers.append(found)
            weights.append(np.full(len(found), often / len(found)))
    slots = np.array([_slots(w) for w in counts], np.int64).reshape(-1, 2)
    often = np.fromiter(counts.values(), np.float64, len(counts))
    lines = text.split("\n")
    shares = (again / max(1, len(words)), 1 - len(set(lines)) / len(lines))
    extra = [(REPEATS + i, s) for i, (s, least) in enumerate((s, x) for s in shares for x in LEVELS) if s > least]
    numbers = np.concatenate([*numbers, slots[:, 0], slots[:, 1], [n for n, _ in extra]]).astype(np.int64)
    weights = np.concatenate([*weights, often, often]) / max(1, len(words))
    found, place = np.unique(numbers, return_inverse=True)
    return found, np.bincount(place, np.concatenate([weights, [s for _, s in extra]]), len(found))


@dataclass
class Model:
    """slot: place of each hashed feature or -1; weight: its idf; basis: latent directions; labelled vectors, labels."""

    slot: np.ndarray
    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit latent vectors; zero where no known feature occurs."""
        out = np.zeros((len(bags), self.basis.shape[1]), np.float32)
        for i, (numbers, shares) in enumerate(bags):
            place = self.slot[numbers]
            known = place >= 0
            place = place[known]
            out[i] = (np.sqrt(shares[known]) * self.weight[place]).astype(np.float32) @ self.basis[place]
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Share of similarity with neighbours of label 1, in blocks; the sample's share where nothing is similar."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            near = self.project([features(t) for t in texts[at : at + BLOCK]]) @ self.vectors.T
            best = np.argpartition(near, -k, axis=1)[:, -k:]
            like = np.clip(np.take_along_axis(near, best, axis=1), 0, None).astype(np.float64)
            votes = (like * self.labels[best]).sum(axis=1) + PRIOR_WEIGHT * self.prior
            out[at : at + BLOCK] = np.clip(votes / (like.sum(axis=1) + PRIOR_WEIGHT), 0, 1)
        return out


def _basis(x: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    rank = min(rank, *x.shape)
    start = np.random.default_rng(7).standard_normal((x.shape[1], rank + 8)).astype(np.float32)
    q = np.linalg.qr(x @ start)[0]
    for _ in range(4):
        q = np.linalg.qr(x @ (x.T @ q))[0]
    return np.linalg.svd(q.T @ x, full_matrices=False)[2][:rank].T.copy()


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, most: int = MOST_LABELLED) -> Model:
    """Learns from at most ``most`` labelled documents, those with the least id hashes among ``train`` rows.

    Rows without label, id or document are left out; several labels of one document count as their mean. Of several
    texts of one id the least is learned. Features of whole texts are made in tasks; the driver gets one row per id of the
    sample.
    """
    labelled = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.where(train) if train is not None else labelled
    labelled = labelled.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    sample = least_hashes(labelled, most)
    bag = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("quality", T.DoubleType()),
            T.StructField("numbers", T.ArrayType(T.LongType())),
            T.StructField("shares", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches):
            bags = [features(t) for t in texts]
            columns = [batch.column("doc_id"), batch.column("quality")]
            columns += [pa.array([b[i] for b in bags], pa.list_(t)) for i, t in enumerate((pa.int64(), pa.float64()))]
            yield pa.record_batch(columns, names=bag.names)

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = one_text(rows, "doc_id", "quality").mapInArrow(run, bag).toArrow().sort_by("doc_id")
    bags = list(zip(lists_of(found, "numbers"), lists_of(found, "shares")))
    return _fitted(bags, found.column("quality").to_numpy())


def _fitted(bags: list, labels: np.ndarray) -> Model:
    n = len(bags)
    seen = np.bincount(np.concatenate([b[0] for b in bags]), minlength=WORDS + SHAPES) if n else np.zeros(WORDS + SHAPES)
    kept = np.flatnonzero(seen >= min(LEAST_DOCS, max(1, n // 20)))
    kept = np.sort(kept[np.argsort(-seen[kept], kind="stable")][:MOST_FEATURES])
    slot = np.full(WORDS + SHAPES, -1, np.int64)
    slot[kept] = np.arange(len(kept))
    weight = np.log((n + 1) / (seen[kept] + 0.5)) + 0.05
    weight[kept < WORDS] *= WORD_WEIGHT
    x = np.zeros((n, len(kept)), np.float32)
    for i, (numbers, shares) in enumerate(bags):
        place = slot[np.asarray(numbers, np.int64)]
        known = place >= 0
        x[i, place[known]] = np.sqrt(np.asarray(shares)[known]) * weight[place[known]]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    basis = _basis(x, RANK) if n and len(kept) else np.zeros((len(kept), 1), np.float32)
    vectors = x @ basis
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Model(slot, weight, basis, vectors, labels, float(labels.mean()) if n else 0.5)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row.

    A null or empty text, or one without known features, gets the sample's share of label 1; without any labelled
    document the score is 0.5. Equal texts score alike; rows may repeat; further columns are not looked at.
    """
    schema = T.StructType([*typed(docs, "doc_id"), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches):
            yield pa.record_batch([batch.column("doc_id"), pa.array(shared.value.scores(texts))], names=schema.names)
        _KNOWN.clear()  # the worker goes on to other stages

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches):
            yield batch.filter(pa.array(shared.value.scores(texts) >= least))
        _KNOWN.clear()  # the worker goes on to other stages

    return docs.mapInArrow(run, docs.schema)


def train_rows() -> Column:
    """Ids whose crc32 leaves 1 to 4 modulo 5."""
    return ~held_out(F.col("doc_id"), 5, 0)
