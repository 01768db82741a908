"""Language identification by error-correcting output codes over character n-grams.

Each language has a codeword; a linear classifier per bit, trained on hashed n-grams of whole words, predicts the bits of
a text. Decoding takes the codeword with the least logistic loss over all bits and flags texts whose runner-up is close.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import lists_of, texts_of, typed
from rosterflow.llm.sampling import id_hash, one_text, within_share

BUCKETS = 1 << 13
#: documents per language that a fit may use, those with the least id hashes
MOST_PER_LANGUAGE = 500
UNKNOWN = "und"
#: least distance between the losses per bit of the two nearest codewords; closer ones are flagged
MARGIN = 0.1
_PRIMES = np.array([2654435761, 2246822519, 3266489917], np.uint64)
#: which code points below 0x3000 are letters; all others count as letters unless they are spaces or punctuation
_LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 3-grams inside and at the edges of words, and the share of each."""
    points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_LETTER[np.minimum(points, 0x2FFF)] | (points >= 0x3000), points, 32)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    p = points[keep].astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    mixed, inner = np.zeros(len(p), np.uint64), p != 32
    for n in range(1, 4):
        if len(p) < n:
            break
        mixed = (mixed[: len(p) - n + 1] + p[n - 1 :]) * _PRIMES[n - 1]
        mixed ^= mixed >> np.uint64(29)
        some = inner if n == 1 else inner[: len(mixed)] | inner[n - 1 :]
        counts += np.bincount((mixed[some] % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found] / max(1, counts.sum())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def codewords(n: int) -> np.ndarray:
    """Rows of +1 and -1 per language: all splits in two for few languages, else the best of 200 random draws."""
    if n <= 5:
        splits = range(1, max(2, 1 << (n - 1)))
        return np.array([[1.0 if s >> i & 1 else -1.0 for s in splits] for i in range(n)])
    rng, bits, best, most = np.random.default_rng(11), int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(200):
        draw = rng.choice([-1.0, 1.0], (n, bits))
        apart = ((bits - draw @ draw.T) / 2 + np.eye(n) * bits).min()
        if apart > most and (np.abs(draw.sum(axis=0)) < n).all():
            best, most = draw, apart
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        names, scores, unsure = [], [], []
        for text in texts:
            if not self.languages or not has_letter(text):
                names.append(UNKNOWN), scores.append(0.0), unsure.append(True)
                continue
            found, shares = grams(text)
            bits = np.sqrt(shares).astype(np.float32) @ self.weights[found] + self.bias
            losses = np.logaddexp(0, -self.codes * bits).mean(axis=1)
            order = np.argsort(losses, kind="stable")
            names.append(self.languages[order[0]])
            odds = np.exp(-(losses - losses[order[0]]) * self.codes.shape[1])
            scores.append(float(odds[order[0]] / odds.sum()))
            unsure.append(bool(len(order) > 1 and losses[order[1]] - losses[order[0]] < MARGIN))
        return names, scores, unsure


def fit(docs: DataFrame, train: Column | None = None, most: int = MOST_PER_LANGUAGE) -> Model:
    """Learns from at most ``most`` documents per language among ``train`` rows with text and language.

    Counts per language, one row each, are sent to all tasks and set a hash threshold that leaves about twice as many
    rows; only these are shuffled, each id once. Of several texts of one id and language the least is learned.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(train) if train is not None else rows
    ids = rows.select("doc_id", "lang", id_hash(F.col("doc_id")).alias("hash"))
    counts = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("lang", "name")
    below = within_share(F.lit(2.0 * most + 50) / F.col("n"))
    few = ids.join(F.broadcast(counts), (F.col("lang") == F.col("name")) & below).select("doc_id", "lang", "hash").distinct()
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    chosen = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang"))
    bag = T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("id", T.StringType()),
            T.StructField("found", T.ArrayType(T.IntegerType())),
            T.StructField("shares", T.ArrayType(T.FloatType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches):
            bags = [grams(t) for t in texts]
            columns = [batch.column("lang"), batch.column("id")]
            columns += [pa.array([b[i] for b in bags], pa.list_(t)) for i, t in enumerate((pa.int32(), pa.float32()))]
            yield pa.record_batch(columns, names=bag.names)

    same = (rows["doc_id"] == chosen["chosen_id"]) & (rows["lang"] == chosen["chosen_lang"])
    sample = rows.join(F.broadcast(chosen), same, "left_semi").select("lang", F.col("doc_id").cast("string").alias("id"), "text")
    found = one_text(sample, "lang", "id").mapInArrow(run, bag).toArrow().sort_by([("lang", "ascending"), ("id", "ascending")])
    return _fitted(found.column("lang").to_pylist(), list(zip(lists_of(found, "found"), lists_of(found, "shares"))))


def _fitted(names: list[str], bags: list, steps: int = 300, rate: float = 4.0, decay: float = 1e-4) -> Model:
    """Logistic regression of all bits together, each language weighing the same; full gradients, fixed steps."""
    languages = sorted(set(names))
    if not languages:
        return Model([], np.zeros((0, 1)), np.zeros((BUCKETS, 1), np.float32), np.zeros(1))
    codes = codewords(len(languages))
    place = np.array([languages.index(n) for n in names])
    x = np.zeros((len(names), BUCKETS), np.float32)
    for i, (found, shares) in enumerate(bags):
        x[i, found] = np.sqrt(shares)
    y = codes[place].astype(np.float32)
    share = 1 / np.bincount(place)[place] / len(languages)
    weights, bias = np.zeros((BUCKETS, codes.shape[1]), np.float32), np.zeros(codes.shape[1])
    speed, drift = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(steps):
        slope = -y / (1 + np.exp(np.clip(y * (x @ weights + bias), -50, 50))) * share[:, None]
        speed = 0.9 * speed - rate * (x.T @ slope.astype(np.float32) + decay * weights)
        drift = 0.9 * drift - 0.1 * rate * slope.sum(axis=0)
        weights, bias = weights + speed, bias + drift
    return Model(languages, codes, weights, bias)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous of every row.

    ``und``, 0 and true where the text is null or has no letter, or where nothing was learned. Equal texts get equal
    answers; rows may repeat; further columns are not looked at.
    """
    schema = T.StructType(
        [
            *typed(docs, "doc_id"),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("ambiguous", T.BooleanType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches):
            found = shared.value.predict(texts)
            kinds = (pa.string(), pa.float64(), pa.bool_())
            columns = [pa.array(c, t) for c, t in zip(found, kinds)]
            yield pa.record_batch([batch.column("doc_id"), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
