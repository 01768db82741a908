"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides.

The vocabulary and the classes are counts over all documents. The network sees the words left and right of a position and
predicts the class of the word there and, from the same hidden layer, the word among those of its class. Every task trains a copy on its own documents
from the same start; the copies are averaged in rounds of a fixed number, so what is gathered grows with the corpus. A
document's score is the sum of the conditional log-probabilities of all its tokens. Words outside the vocabulary enter the network by hash bucket; in the
score each counts with its own share of its bucket: the more frequent ones from a bounded list that every task has, all
others joined from the counts of all words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import texts_of, typed
from rosterflow.session import stage

#: words with a number of their own, and buckets by hash for all others; the last number marks the edge of a text
VOCABULARY, OTHERS = 8192, 256
SYMBOLS = VOCABULARY + OTHERS + 1
EDGE = SYMBOLS - 1
#: classes that the network predicts, words seen on each side, size of the hidden layer
CLASSES, SIDE, HIDDEN = 64, 2, 16
#: positions of a task's first gradient steps and of later ones, an eighth of those seen so far in between; the first
#: step's rate, and positions that are held at once
FIRST_BATCH, BATCH, RATE, AT_ONCE = 1024, 1 << 14, 0.6, 1 << 14
#: positions of a step whose class slopes are made together, so that they stay in the processor's cache
CACHED = 1 << 11
#: occurrences of a symbol, and half their root for the words of a class, beyond which steps count means and not sums
OFTEN, WORD_PACE = 25, 5
#: greatest logit whose exponential is made
MOST_LOGIT = 80
#: models that are averaged by one task
FAN_IN = 32
_EDGES = np.full(SIDE, EDGE)
#: distinct words that a counting task holds before it hands them on
MOST_COUNTED = 300_000
#: log shares of words are summed as whole multiples of 1 / SCALE, so the order of the rows does not matter
SCALE = 10**8
REMEMBERED, LONGEST = 400_000, 64
#: most words outside the vocabulary whose shares every task has; those of all others are joined
LISTED = 1 << 17


def tokens_of(text: str) -> list[str]:
    """Lower-case words, parted by white space."""
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents; tasks sum up before words are shuffled."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = list(held)
            out = pa.record_batch([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=schema.names)
            held.clear()
            return out

        for _, texts in texts_of(batches):
            for text in texts:
                held.update(tokens_of(text))
                if len(held) > MOST_COUNTED:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


class _Numbers(dict):
    """Symbol of each word; words outside the vocabulary are remembered up to REMEMBERED. Words of a further list have
    numbers from SYMBOLS on instead, in its order."""

    def __init__(self, vocabulary: list[str], listed: Iterable[str] = ()):
        self.own = {w: i for i, w in enumerate(vocabulary)}
        self.own.update((w, i) for i, w in enumerate(listed, SYMBOLS))
        super().__init__(self.own)

    def __missing__(self, word: str) -> int:
        symbol = VOCABULARY + crc32(word.encode("utf-8", "replace")) % OTHERS
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
                self.update(self.own)
            self[word] = symbol
        return symbol

    def symbols(self, words: str | list[str]) -> np.ndarray:
        """Symbols of a text, or of its words."""
        words = tokens_of(words) if isinstance(words, str) else words
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Counts:
    """vocabulary by falling count; class of each symbol; log of each symbol's share of its class, by corpus counts;
    tokens and distinct words outside the vocabulary of each bucket; the most frequent of these words with their shares, as
    in ``rest_shares``."""

    vocabulary: list[str]
    group: np.ndarray
    within: np.ndarray
    tokens: np.ndarray
    kinds: np.ndarray
    listed: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        #: symbols class by class, where each class starts among them, and the place of each symbol
        self.members = np.argsort(self.group, kind="stable")
        self.starts = np.searchsorted(self.group[self.members], np.arange(CLASSES + 1))
        self.place = np.argsort(self.members)
        self.shares = self.within[self.members].astype(np.float32)


def count(docs: DataFrame, words: DataFrame | None = None) -> Counts:
    """Counts over all documents; the VOCABULARY most frequent words come to the driver, one sum per bucket, and the shares
    of up to LISTED further words: all those of the greatest counts, in steps of a sixteenth power of two, that have at most
    LONGEST characters.

    ``words``: the staged ``word_counts`` of the documents, if they are at hand.
    """
    counts = stage(word_counts(docs), "word-counts") if words is None else words
    # sizes of the counts first: only words that may be among the most frequent are sorted and leave their tasks
    size = F.floor(F.log2(F.col("n").cast("double")) * 16).alias("size")
    sizes = sorted(((r["size"], r["words"]) for r in counts.groupBy(size).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    upto = [s for i, (s, _) in enumerate(sizes) if sum(w for _, w in sizes[:i]) < VOCABULARY]
    often = counts.where(size >= F.lit(min(upto, default=0)))
    top = often.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    vocabulary = [r["word"] for r in top]
    bucket = F.crc32(F.col("word").cast("binary")) % OTHERS
    found = counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    sums, kinds = {r["b"]: r["n"] for r in found}, {r["b"]: r["words"] for r in found}
    for r in top:
        sums[crc32(r["word"].encode()) % OTHERS] -= r["n"]
        kinds[crc32(r["word"].encode()) % OTHERS] -= 1
    n = np.zeros(SYMBOLS)
    n[: len(top)] = [r["n"] for r in top]
    n[VOCABULARY : VOCABULARY + OTHERS] = [sums.get(b, 0) for b in range(OTHERS)]
    share = np.sqrt(n + 1)
    order = np.argsort(-n, kind="stable")
    group = np.empty(SYMBOLS, np.int64)
    group[order] = np.minimum(np.cumsum(share[order]) / share.sum() * CLASSES, CLASSES - 1).astype(np.int64)
    total = np.bincount(group, n + 1, CLASSES)
    rest = [np.array([x.get(b, 0) for b in range(OTHERS)], np.int64) for x in (sums, kinds)]
    ends = np.cumsum([w for _, w in sizes])
    least = [s for (s, _), end in zip(sizes, ends) if end <= VOCABULARY + LISTED]
    known = set(vocabulary)
    short = counts.where((size >= F.lit(min(least, default=0))) & (F.length("word") <= LONGEST))
    shares = short.select("word", _own_share(*rest).alias("share")).collect() if least else []
    listed = {r["word"]: r["share"] for r in shares if r["word"] not in known}
    return Counts(vocabulary, group, np.log((n + 1) / total[group]), *rest, listed)


def _own_share(tokens: np.ndarray, kinds: np.ndarray) -> Column:
    """Log of the share of ``word`` with the count ``n``, null for an unseen one, in its bucket, in multiples of 1 / SCALE."""
    bucket = (F.crc32(F.col("word").cast("binary")) % OTHERS + 1).cast("int")
    seen = F.lit(np.log(tokens + 1.0).tolist())
    unseen = F.lit((-np.log(tokens + 1.0) - np.log(kinds + 1.0)).tolist())
    own = F.coalesce(F.log(F.col("n").cast("double")) - F.element_at(seen, bucket), F.element_at(unseen, bucket))
    return F.round(own * SCALE).cast("long")


class Network:
    """log p(word | words on both sides): a table per place of the window, a hidden layer, a softmax over classes and one
    over the words of the true class, which starts from their corpus shares."""

    def __init__(self, vector: np.ndarray | None = None):
        rng = np.random.default_rng(3)
        sizes = [(2 * SIDE * SYMBOLS, HIDDEN), (HIDDEN, CLASSES), (1, HIDDEN), (1, CLASSES), (SYMBOLS, HIDDEN), (1, SYMBOLS)]
        if vector is None:
            parts = [rng.normal(0, 0.1, s).astype(np.float32) for s in sizes[:2]] + [np.zeros(s, np.float32) for s in sizes[2:]]
        else:
            ends = np.cumsum([a * b for a, b in sizes])[:-1]
            parts = [p.reshape(s).copy() for p, s in zip(np.split(vector, ends), sizes)]
        # rows of words and lean are in the order of Counts.members
        self.table, self.out, self.bias, self.prior, self.words, self.lean = parts

    def vector(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.table, self.out, self.bias, self.prior, self.words, self.lean)])

    @staticmethod
    def windows(symbols: np.ndarray) -> np.ndarray:
        """Rows of the table for every position of a short text, one column per place of the window."""
        return next(_slices([symbols], len(symbols) + 1)).windows if len(symbols) else np.empty((0, 2 * SIDE), np.int64)

    def _safe(self, counts: Counts | None = None) -> bool:
        """Whether no logit can exceed what _exp holds: a hidden unit is within -1 and 1."""
        most = np.abs(self.out).sum(axis=0) + self.prior[0]
        if counts is None:
            return bool(most.max() < MOST_LOGIT - 1)
        among = np.abs(self.words).sum(axis=1) + self.lean[0] + counts.shares
        return bool(max(most.max(), among.max()) < MOST_LOGIT - 1)

    def _forward(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        summed = self.table.take(windows[:, 0], axis=0)
        for i in range(1, windows.shape[1]):
            summed += self.table.take(windows[:, i], axis=0)
        summed += self.bias
        hidden = np.tanh(summed, out=summed)
        logits = hidden @ self.out
        logits += self.prior
        return hidden, logits

    def log_probabilities(self, windows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        _, logits = self._forward(windows)
        own = logits[np.arange(len(classes)), classes]
        return own - np.log(_sums(_exp(logits, self._safe())))

    def word_log_probabilities(self, windows: np.ndarray, symbols: np.ndarray, counts: Counts) -> np.ndarray:
        """log p(word | both sides) over all symbols: that of the class and that of the word among those of its class."""
        safe, classes = self._safe(counts), counts.group[symbols]
        hidden, logits = self._forward(windows)
        found = logits[np.arange(len(classes)), classes]
        found -= np.log(_sums(_exp(logits, safe)))
        order, groups = _by_class(classes, counts)
        hidden, place = hidden.take(order, axis=0), counts.place[symbols.take(order)]
        inner = np.zeros(len(classes), np.float32)
        for at, low, high in groups:
            among = self._among(hidden[at], low, high, counts)
            inner[at] = among[np.arange(len(among)), place[at] - low]
            inner[at] -= np.log(_sums(_exp(among, safe)))
        found[order] += inner
        return found

    def _among(self, hidden: np.ndarray, low: int, high: int, counts: Counts) -> np.ndarray:
        among = hidden @ self.words[low:high].T
        among += self.lean[0, low:high] + counts.shares[low:high]
        return among

    def _step_words(self, hidden: np.ndarray, symbols: np.ndarray, counts: Counts, rate: float, safe: bool) -> np.ndarray:
        """One gradient step of the words of each class that occurs; the gradient of the hidden layer comes back."""
        order, groups = _by_class(counts.group[symbols], counts)
        hidden, place = hidden.take(order, axis=0), counts.place[symbols.take(order)]
        sorted_back = np.zeros_like(hidden)
        for at, low, high in groups:
            inner, back = hidden[at], sorted_back[at]
            # slopes times the sum of their row, which is divided out where rows are narrow
            slope = _exp(self._among(inner, low, high, counts), safe)
            total = _sums(slope)
            slope[np.arange(len(slope)), place[at] - low] -= total
            share = np.reciprocal(total)
            np.matmul(slope, self.words[low:high], out=back)
            back *= share[:, None]
            share *= np.float32(rate * 0.3 * min(len(slope) ** -0.5, WORD_PACE / len(slope)))
            self.words[low:high] -= slope.T @ (inner * share[:, None])
            self.lean[0, low:high] -= share @ slope
        back = np.empty_like(hidden)
        back[order] = sorted_back
        return back

    def step(self, windows: np.ndarray, symbols: np.ndarray, counts: Counts, rate: float) -> None:
        """One gradient step on the mean loss; the table moves by each position's own gradient."""
        safe, classes = self._safe(counts), counts.group[symbols]
        hidden = np.empty((len(classes), HIDDEN), np.float32)
        inner = np.empty_like(hidden)
        out, prior = np.zeros_like(self.out), np.zeros_like(self.prior)
        for at in range(0, len(classes), CACHED):
            some = slice(at, at + CACHED)
            hidden[some], slope = self._forward(windows[some])
            _exp(slope, safe)
            slope /= _sums(slope)[:, None]
            slope[np.arange(len(slope)), classes[some]] -= 1
            np.matmul(slope, self.out.T, out=inner[some])
            out += hidden[some].T @ slope
            prior += slope.sum(axis=0)
        inner += self._step_words(hidden, symbols, counts, rate, safe)
        inner *= 1 - hidden * hidden
        self.out -= np.float32(rate * 1.5 / len(classes)) * out
        self.prior -= np.float32(rate * 1.5 / len(classes)) * prior
        self.bias -= np.float32(rate) * inner.mean(axis=0)
        inner *= np.float32(-rate * 0.3)
        self._step_table(inner, windows)

    def _step_table(self, moves: np.ndarray, windows: np.ndarray) -> None:
        """Adds each position's move to its rows; a row that occurs more than OFTEN times moves as if it did OFTEN times."""
        columns = np.ascontiguousarray(moves.T, dtype=np.float64)
        summed = np.empty((HIDDEN, SYMBOLS))
        for i in range(windows.shape[1]):
            first = i * SYMBOLS
            rows, table = windows[:, i] - first, self.table[first : first + SYMBOLS]
            times = np.bincount(rows, minlength=SYMBOLS)
            used = np.flatnonzero(times)
            for j, column in enumerate(columns):
                summed[j] = np.bincount(rows, column, SYMBOLS)
            # rows that do not occur stay as they are
            table[used] += (summed.take(used, axis=1) * (OFTEN / np.maximum(times[used], OFTEN))).T


def _exp(x: np.ndarray, safe: bool = False) -> np.ndarray:
    """exp in place; values beyond MOST_LOGIT count as that, which float32 can still sum. ``safe``: there are none."""
    if not safe:
        np.minimum(x, MOST_LOGIT, out=x)
    return np.exp(x, out=x)


def _sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], np.float32)


@dataclass
class Slice:
    """Positions of some documents: the place of each position's document in their list, its symbol and its window."""

    owner: np.ndarray
    symbols: np.ndarray
    windows: np.ndarray


def _slices(documents: Iterable[np.ndarray], most: int = AT_ONCE) -> Iterator[Slice]:
    """All positions of the documents in order, in slices of about ``most``; long documents are cut, windows are whole."""
    held: list[tuple[int, np.ndarray, int]] = []
    size = 0
    for i, symbols in enumerate(documents):
        for at in range(0, len(symbols), most):
            part = symbols[max(0, at - SIDE) : at + most + SIDE]
            n = min(most, len(symbols) - at)
            left, right = SIDE - min(at, SIDE), SIDE - min(SIDE, len(symbols) - at - n)
            held.append((i, np.concatenate((_EDGES[:left], part, _EDGES[:right])), n))
            size += n
            if size >= most:
                yield _slice(held)
                held, size = [], 0
    if held:
        yield _slice(held)


def _slice(held: list[tuple[int, np.ndarray, int]]) -> Slice:
    padded = np.concatenate([part for _, part, _ in held])
    sizes = np.array([n for _, _, n in held])
    # each part has SIDE symbols before and behind its positions
    place = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)) * 2 * SIDE + SIDE, sizes)
    windows = np.empty((len(place), 2 * SIDE), np.int64)
    for column, step in enumerate(k for k in range(-SIDE, SIDE + 1) if k):
        windows[:, column] = padded[place + step]
        windows[:, column] += column * SYMBOLS
    return Slice(np.repeat([i for i, _, _ in held], sizes), padded[place], windows)


def _by_class(classes: np.ndarray, counts: Counts) -> tuple[np.ndarray, list[tuple[slice, int, int]]]:
    """Positions in the order of their classes, and of each class of more than one word the stretch there and the bounds of
    its members."""
    order = np.argsort(classes.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(classes, minlength=CLASSES)).tolist()
    groups, start = [], 0
    for k, end in enumerate(ends):
        low, high = int(counts.starts[k]), int(counts.starts[k + 1])
        if end > start and high - low > 1:
            groups.append((slice(start, end), low, high))
        start = end
    return order, groups


def encode(docs: DataFrame, counts: Counts) -> DataFrame:
    """(doc_id, symbols, row, listed, rest) of every row, written once for training and scoring; symbols as 16-bit
    little-endian bytes, a number of the row, the sum of the shares of its listed words, and its other words outside the
    vocabulary with how often each occurs.

    A null text has no symbols. Equal rows all stay; further columns are not looked at.
    """
    rest = T.StructType([T.StructField("word", T.StringType()), T.StructField("times", T.LongType())])
    schema = T.StructType(
        [
            *typed(docs, "doc_id"),
            T.StructField("symbols", T.BinaryType()),
            T.StructField("row", T.LongType()),
            T.StructField("listed", T.LongType()),
            T.StructField("rest", T.ArrayType(rest)),
        ]
    )
    listed = list(counts.listed)
    # by the numbers of the words: their symbols and their shares, 0 for those of the vocabulary
    symbol_of = [*range(SYMBOLS), *(VOCABULARY + crc32(w.encode()) % OTHERS for w in listed)]
    share_of = [0] * SYMBOLS + list(counts.listed.values())
    tables = np.array(symbol_of, "<u2"), np.array(share_of, np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((counts.vocabulary, listed, *tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, listed, symbol_of, share_of = shared.value
        numbers, row = _Numbers(vocabulary, listed), TaskContext.get().partitionId() << 40
        for batch, texts in texts_of(batches):
            packed, sums, words, times, ends = [], [], [], [], [0]
            for text in texts:
                own = tokens_of(text)
                found = numbers.symbols(own)
                others = np.flatnonzero((found >= VOCABULARY) & (found < SYMBOLS)).tolist()
                if others:
                    counted = Counter([own[i] for i in others])
                    words += counted.keys()
                    times += counted.values()
                packed.append(symbol_of.take(found).tobytes())
                sums.append(int(share_of.take(found).sum()))
                ends.append(len(words))
            pairs = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())], names=rest.names)
            columns = [pa.array(packed, pa.binary()), pa.array(range(row, row + len(texts)), pa.int64()), pa.array(sums, pa.int64())]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs))
            row += len(texts)
            yield pa.record_batch([batch.column("doc_id"), *columns], names=schema.names)

    return stage(docs.select("doc_id", "text").mapInArrow(run, schema), "symbols")


def _symbols_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, [np.frombuffer(b, "<u2").astype(np.int64) for b in batch.column("symbols").to_pylist()]


def _trained(documents: Iterator[np.ndarray], counts: Counts) -> Network:
    """One pass over all positions of the documents of a task, shuffled in parts."""
    network, seen = Network(), 0
    for part in _slices(documents, BATCH * 4):
        order, at = np.random.default_rng(seen).permutation(len(part.symbols)), 0
        while at < len(order):
            some = order[at : at + min(max(seen // 8, FIRST_BATCH), BATCH)]
            network.step(part.windows.take(some, axis=0), part.symbols.take(some), counts, RATE / (1 + seen / 2e6) ** 0.5)
            seen += len(some)
            at += len(some)
    return network


def train(encoded: DataFrame, counts: Counts) -> Network:
    """Learns from every position of every document. Averages the models of all tasks, weighed by their tokens, FAN_IN at a time; one model comes to the driver."""
    schema = T.StructType(
        [T.StructField("part", T.LongType()), T.StructField("weight", T.DoubleType()), T.StructField("model", T.BinaryType())]
    )
    shared = encoded.sparkSession.sparkContext.broadcast(replace(counts, listed={}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = 0

        def documents() -> Iterator[np.ndarray]:
            nonlocal words
            for _, found in _symbols_of(batches):
                for symbols in found:
                    words += len(symbols)
                    yield symbols

        vector = _trained(documents(), shared.value).vector()
        if words:
            row = [TaskContext.get().partitionId()], [float(words)], [vector.astype("<f4").tobytes()]
            kinds = (pa.int64(), pa.float64(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(row, kinds)], names=schema.names)

    def average(rows: pd.DataFrame) -> pd.DataFrame:
        weight, total = float(rows["weight"].sum()), None
        for part, own, model in sorted(zip(rows["part"], rows["weight"], rows["model"]), key=lambda r: (r[0], r[1])):
            scaled = np.frombuffer(model, "<f4").astype(np.float64) * (own / weight)
            total = scaled if total is None else total + scaled
        row = int(rows["part"].min()) // FAN_IN, weight, total.astype("<f4").tobytes()
        return pd.DataFrame([row], columns=schema.names)

    models = stage(encoded.select("symbols").mapInArrow(run, schema), "pseudo-models")
    most = models.agg(F.max("part")).first()[0]
    while most is not None and most > 0:
        models = stage(models.groupBy(F.expr(f"part DIV {FAN_IN}")).applyInPandas(average, schema), "pseudo-averages")
        most //= FAN_IN
    last = models.first()
    return Network(np.frombuffer(last["model"], "<f4")) if last else Network()


def rest_shares(encoded: DataFrame, counts: Counts, words: DataFrame) -> DataFrame:
    """(row, share): sum over a row's tokens in ``rest`` of the log of the word's share of its bucket.

    A word seen n times among N tokens of its bucket has n / (N + 1). One count is kept back for unseen words and spread
    over as many of them as the bucket has known ones, and one more. ``share`` is a whole multiple of 1 / SCALE. The rows
    are joined by word; a word outside the vocabulary has less than one token in VOCABULARY.
    """
    pairs = encoded.select("row", F.inline("rest")).join(words.select("word", "n"), "word", "left")
    scaled = _own_share(counts.tokens, counts.kinds) * F.col("times")
    return pairs.select("row", scaled.alias("share")).groupBy("row").agg(F.sum("share").alias("share"))


def score(encoded: DataFrame, counts: Counts, network: Network, words: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum over all tokens) and mean_log_likelihood of every row.

    ``words``: the staged ``word_counts``, with which the network predicts every word, and each word outside the vocabulary
    has its own share of its bucket; without them it predicts classes, and words have their corpus shares. A null or empty text has no tokens, sum 0 and a null mean. Equal texts score alike; rows may repeat; an empty table
    gives no rows; further columns are not looked at. The symbols of a text (two bytes a token) are held whole, its
    positions go through the network in slices of AT_ONCE.
    """
    schema = T.StructType(
        [
            *typed(encoded, "doc_id"),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("log_likelihood", T.DoubleType()),
            T.StructField("mean_log_likelihood", T.DoubleType()),
            T.StructField("row", T.LongType()),
            T.StructField("listed", T.LongType()),
        ]
    )
    shared = encoded.sparkSession.sparkContext.broadcast((replace(counts, listed={}), network.vector()))
    by_word = words is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, vector = shared.value
        net = Network(vector)
        for batch, documents in _symbols_of(batches):
            sizes = [len(symbols) for symbols in documents]
            sums = likelihoods(net, found, documents, by_word).tolist()
            means = [s / n if n else None for s, n in zip(sums, sizes)]
            columns = [pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()), pa.array(means, pa.float64())]
            columns = [batch.column("doc_id"), *columns, batch.column("row"), batch.column("listed")]
            yield pa.record_batch(columns, names=schema.names)

    scored = encoded.select("doc_id", "symbols", "row", "listed").mapInArrow(run, schema)
    if words is None:
        return scored.drop("row", "listed")
    both = scored.join(rest_shares(encoded, counts, words), "row", "left")
    total = F.col("log_likelihood") + (F.col("listed") + F.coalesce("share", F.lit(0))) / SCALE
    mean = F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))
    return both.select("doc_id", "n_tokens", total.alias("log_likelihood"), mean.alias("mean_log_likelihood"))


def likelihoods(network: Network, counts: Counts, documents: list[np.ndarray], by_word: bool = True) -> np.ndarray:
    """For each document the sum over its positions of log p(word | both sides), a word outside the vocabulary as its
    bucket; not ``by_word``: of log p(class | both sides) + log p(word | class)."""
    sums = np.zeros(len(documents))
    for part in _slices(documents):
        if by_word:
            found = network.word_log_probabilities(part.windows, part.symbols, counts)
        else:
            found = network.log_probabilities(part.windows, counts.group[part.symbols]) + counts.within[part.symbols]
        first = part.owner[0]
        own = np.bincount(part.owner - first, found)
        sums[first : first + len(own)] += own
    return sums


def pseudo_likelihood(network: Network, counts: Counts, symbols: np.ndarray) -> float:
    """Of one text: sum over positions of log p(class | both sides) + log p(word | class)."""
    return float(likelihoods(network, counts, [symbols], False)[0])


def word_likelihood(network: Network, counts: Counts, symbols: np.ndarray) -> float:
    """Of one text: sum over positions of log p(word | both sides)."""
    return float(likelihoods(network, counts, [symbols])[0])
