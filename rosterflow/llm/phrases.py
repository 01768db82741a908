"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing labels each symbol from itself and a few symbols to its left, and cuts where a label is a
local maximum; each phrase gets the hash of its symbols as name, and the names are parsed again one level up. A cut
depends on a few neighbours only, so equal substrings get equal phrases inside, wherever they stand. A fingerprint is a
min-hash sketch of the phrase names of two levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import typed
from rosterflow.session import stage

#: levels whose phrases are sketched: about 8 and 24 characters each; and numbers of 16 bits per level
LEVELS, SLOTS = (2, 3), 64
#: rounds of coin tossing that bring 64-bit names to labels 0 to 5
TOSSES = 4
#: characters of texts that are parsed side by side at least, or one text
_TOGETHER = 1 << 15
#: texts whose edited forms are held at once
_SLICE = 1000
_ONE = np.uint64(1)
_RATE = 0x9E3779B97F4A7C15
_RNG = np.random.default_rng(5)
_MULTIPLY = _RNG.integers(1 << 31, size=SLOTS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(1 << 32, size=SLOTS, dtype=np.uint32)
EMPTY = "f" * (4 * SLOTS * len(LEVELS))


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Place and value of the lowest bit unlike the left neighbour's, as one small number; neighbours stay unlike."""
    unlike = names.copy()
    unlike[1:] ^= names[:-1]
    unlike[first] = 1
    low = np.bitwise_count((unlike & -unlike) - names.dtype.type(1))
    return low * np.uint8(2) + ((names >> low) & names.dtype.type(1)).astype(np.uint8)


#: the same for two neighbouring labels below 128, by left * 128 + right
_PAIRS = np.array(
    [2 * (low := ((a ^ b) & -(a ^ b)).bit_length() - 1) + (b >> low & 1) if a != b else 0 for a in range(128) for b in range(128)],
    np.uint8,
)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _rates(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd rate and of its inverse modulo 2 ** 64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        rates = (_RATE, pow(_RATE, -1, 1 << 64))
        _powers = tuple(np.cumprod(np.concatenate(([_ONE], np.full(size, r, np.uint64)))) for r in rates)
    return _powers[0][:n], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of an equal name become one name that knows their length, so neighbours differ."""
    fresh = np.empty(len(names), bool)
    np.not_equal(names[1:], names[:-1], out=fresh[1:])
    fresh[first] = True
    start = np.flatnonzero(fresh)
    if len(start) == len(names):
        return names, first
    length = np.diff(start, append=len(names))
    out, long = names[start].astype(np.uint64), np.flatnonzero(length > 1)
    out[long] = _mix(out[long] + length[long].astype(np.uint64) * np.uint64(_RATE))
    return out, np.searchsorted(start, first)


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small labels of which neighbours differ, each from a symbol and TOSSES symbols to its left."""
    label = _toss(names, first)
    for _ in range(TOSSES - 1):
        pair = np.empty(len(label), np.uint16)
        pair[1:] = label[:-1]
        pair[first] = label[first] ^ 1
        label = _PAIRS[pair * np.uint16(128) + label]
    return label


def parse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases one level up. ``first``: where each text begins; texts do not touch each other."""
    names, first = _runs(names, first)
    label = _labels(names, first)
    cut = np.zeros(len(names), bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    cut[first[1:] - 1] = False
    cut[first] = True
    start = np.flatnonzero(cut)
    power, inverse = _rates(len(names))
    upto = np.cumsum(names * power, dtype=np.uint64)
    end = np.append(start[1:], len(names)) - 1
    total = upto[end]
    total[1:] -= upto[end[:-1]]
    return _mix(total * inverse[start] + (end - start).astype(np.uint64)), np.searchsorted(start, first)


def _phrases(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names and beginnings of texts that are not empty, parsed side by side, for each of LEVELS."""
    names = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts[:-1]]))).astype(np.int64)
    for level in range(1, max(LEVELS) + 1):
        names, first = parse(names, first)
        if level in LEVELS:
            yield names, first


def phrase_names(text: str) -> list[np.ndarray]:
    """Names of a text's phrases in order, for each of LEVELS; none for the empty text."""
    return [names for names, _ in _phrases([text])] if text else [np.zeros(0, np.uint64)] * len(LEVELS)


def _sketches(texts: list[str]) -> list[str]:
    parts = []
    for names, first in _phrases(texts):
        hashed = names.astype(np.uint32)[:, None] * _MULTIPLY + _ADD
        parts.append(np.minimum.reduceat(hashed, first, axis=0))
    numbers = _mix(np.concatenate(parts, axis=1).astype(np.uint64)) >> np.uint64(48)
    return [row.tobytes().hex() for row in numbers.astype(">u2")]


def fingerprints_of(texts: list[str]) -> list[str]:
    """64 minima of 16 bits per level in hex; all f for the empty text. Equal texts have equal fingerprints."""
    out, group, chars = [EMPTY] * len(texts), [], 0
    for i, text in enumerate(texts):
        if text:
            group.append(i)
            chars += len(text)
        if group and (chars >= _TOGETHER or i == len(texts) - 1):
            for at, sketch in zip(group, _sketches([texts[g] for g in group])):
                out[at] = sketch
            group, chars = [], 0
    return out


def fingerprint(text: str) -> str:
    return fingerprints_of([text])[0]


def likeness(a: str, b: str) -> float:
    """Share of equal numbers, which estimates the share of common phrases; 0 between empty and other texts."""
    if a == b:
        return 1.0
    if EMPTY in (a, b):
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(v), ">u2") for v in (a, b))
    return float((x == y).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row; a null text is empty. Further columns are not looked at."""
    schema = T.StructType([*typed(docs, "doc_id"), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = fingerprints_of([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column("doc_id"), pa.array(prints, pa.string())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the first characters, as many or all, of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _rows(now: list[tuple], following: list[tuple]) -> list[tuple]:
    """Result rows of (doc_id, text, fingerprint) and the (doc_id, text, fingerprint) after each."""
    changed = [edited(a[1], b[1]) for a, b in zip(now, following)]
    shas = [hashlib.sha256(c.encode()).hexdigest() for c in changed]
    return [
        (doc_id, len(text), sha, own, other, likeness(own, other), likeness(own, after[2]))
        for (doc_id, text, own), after, sha, other in zip(now, following, shas, fingerprints_of(changed))
    ]


def edit_trial(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.

    The next row is that of the next greater id; after the last comes the first. A null text is empty, a null id comes
    first, rows of equal id are ordered by a hash of the text, a single row is its own next, an empty table gives no rows; further
    columns are not looked at. Texts are sorted once in ranges, compressed (equal ids are split by the hash, so they do
    not pile up in one task). Each task hands over its first and its last text, which are then matched by task.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit("")).alias("text")
    keys = [F.col("doc_id").asc_nulls_first(), F.col("turn").asc()]
    small = T.StructType(
        [*typed(docs, "doc_id"), T.StructField("turn", T.LongType()), T.StructField("packed", T.BinaryType())]
    )
    rows = docs.select("doc_id", text).select("doc_id", F.xxhash64("text").alias("turn"), "text")
    rows = rows.mapInArrow(_squeeze, small).repartitionByRange(*keys).sortWithinPartitions(*keys)
    result = [
        *typed(docs, "doc_id"),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")),
    ]
    edge = [T.StructField("part", T.IntegerType()), T.StructField("side", T.StringType()), T.StructField("text", T.StringType())]
    prints = ("fingerprint", "edited_fingerprint")
    narrow = [T.StructField(f.name, T.BinaryType()) if f.name in prints else f for f in result]
    schema = T.StructType([*narrow, *edge])
    staged = stage(rows.mapInArrow(_within(schema), schema), "phrases")
    staged = staged.withColumns({n: F.lower(F.hex(n)) for n in prints})
    done = staged.where("side IS NULL").select(*[f.name for f in result])
    ends = staged.where("side IS NOT NULL")
    parts = sorted(r[0] for r in ends.select("part").distinct().collect())
    if not parts:
        return done
    turn = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, following int")
    last = ends.where("side = 'last'").select("part", "doc_id", "text", "fingerprint").join(turn, "part")
    first = ends.where("side = 'first'").select(
        F.col("part").alias("following"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print")
    )
    across = last.join(first, "following").select("doc_id", "text", "fingerprint", "next_text", "next_print")
    return done.unionByName(across.mapInArrow(_across(T.StructType(result)), T.StructType(result)))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        packed = pa.array([compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.record_batch([batch.column("doc_id"), batch.column("turn"), packed], names=["doc_id", "turn", "packed"])


def _within(schema: T.StructType):
    """Rows of one range, in order; the first is handed over as well, the last instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, blank = TaskContext.get().partitionId(), [], (None,) * 3
        restore, raw = zstandard.ZstdDecompressor().decompress, bytes.fromhex
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                texts, out = [restore(p).decode() for p in batch.column("packed").to_pylist()], []
                rows = list(zip(batch.column("doc_id").to_pylist(), texts, fingerprints_of(texts)))
                if not held:
                    out.append((rows[0][0], *blank[:2], raw(rows[0][2]), *blank, part, "first", rows[0][1]))
                rows = held + rows
                for doc_id, n, sha, own, other, *near in _rows(rows[:-1], rows[1:]):
                    out.append((doc_id, n, sha, raw(own), raw(other), *near, *blank))
                held = rows[-1:]
                if out:
                    yield _batch(out, schema)
        for doc_id, text, own in held:
            yield _batch([(doc_id, *blank[:2], raw(own), *blank, part, "last", text)], schema)

    return run


def _across(schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            now = list(zip(columns["doc_id"], columns["text"], columns["fingerprint"]))
            following = [(None, t, p) for t, p in zip(columns["next_text"], columns["next_print"])]
            if now:
                yield _batch(_rows(now, following), schema)

    return run
