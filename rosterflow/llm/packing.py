"""Bounded-space online packing of token ids into windows of a fixed length.

Each task keeps a fixed number of open windows, places a piece best-fit, emits the fullest window when none fits and
hands its open windows over at the end; these leftovers are merged in rounds of a fixed number of tasks. Texts are
tokenised and packed where they are read, so ids are never shuffled, except those of leftovers.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import texts_of, typed
from rosterflow.llm.tokens import MOST_CORES, encoder
from rosterflow.session import stage

#: tasks whose leftovers meet in one task of the next round
FAN_IN = 64


class Packer:
    """Open windows of one task. Pieces are (doc, start, ids, doc_tokens); closed windows are lists of pieces."""

    def __init__(self, length: int, most_open: int, min_cut: int):
        self.length, self.most_open, self.min_cut = length, most_open, min_cut
        self.windows: dict[int, list] = {}
        self.free: list[tuple[int, int]] = []
        self.made = 0

    def add(self, doc, ids: np.ndarray, start: int, doc_tokens: int) -> Iterator[list]:
        """Places one piece; yields the windows that this closes."""
        at, n = 0, len(ids)
        while n - at >= self.length:
            yield [(doc, start + at, ids[at : at + self.length], doc_tokens)]
            at += self.length
        while at < n:
            left = n - at
            place = bisect_left(self.free, (left, -1))
            if place < len(self.free):
                free, key = self.free.pop(place)
                self.windows[key].append((doc, start + at, ids[at:], doc_tokens))
                if free == left:
                    yield self.windows.pop(key)
                else:
                    insort(self.free, (free - left, key))
                return
            if len(self.free) < self.most_open:
                self.made += 1
                self.windows[self.made] = [(doc, start + at, ids[at:], doc_tokens)]
                insort(self.free, (self.length - left, self.made))
                return
            free, key = self.free.pop(0)
            window = self.windows.pop(key)
            if self.min_cut <= free <= left - self.min_cut:
                window.append((doc, start + at, ids[at : at + free], doc_tokens))
                at += free
            yield window

    def rest(self) -> Iterator[list]:
        """The windows still open."""
        yield from self.windows.values()


def _closed(pieces: list, length: int) -> Iterator[list]:
    """Cuts the last leftovers into full windows, and the remainder into powers of two, so nothing is padded."""
    total = sum(len(p[2]) for p in pieces)
    sizes = [length] * (total // length) + [1 << b for b in range(length.bit_length(), -1, -1) if (total % length) >> b & 1]
    queue, window = iter(sizes), []
    room = next(queue, 0)
    for doc, start, ids, doc_tokens in pieces:
        at = 0
        while at < len(ids):
            take = min(room, len(ids) - at)
            window.append((doc, start + at, ids[at : at + take], doc_tokens))
            at, room = at + take, room - take
            if not room:
                yield window
                window, room = [], next(queue, 0)


class _Out:
    """Rows of one task's output, in Arrow batches."""

    def __init__(self, schema: pa.Schema, first: int, keep_ids: bool):
        self.schema, self.next, self.keep_ids, self.rows = schema, first, keep_ids, []

    def window(self, pieces: list, part: int | None = None) -> None:
        offset = 0
        for doc, start, ids, doc_tokens in pieces:
            raw = np.asarray(ids, "<u4").tobytes()
            kept = raw if self.keep_ids or part is not None else None
            self.rows.append((doc, start, len(ids), crc32(raw), doc_tokens, self.next, offset, part, kept))
            offset += len(ids)
        self.next += 1

    def flush(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            columns = zip(*self.rows)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
            self.rows = []


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    length: int = 2048,
    open_windows: int = 64,
    end_id: int = 1,
    min_cut: int = 32,
    keep_ids: bool = True,
    remembered: int = MOST_CORES,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (uint32,
    little-endian bytes) if ``keep_ids``.

    A document is the ids of its whole text, then ``end_id``; a null or empty text is that id alone. Equal rows are
    packed each for itself, a null id stays null, an empty table gives no pieces, further columns are not looked at.
    The fullest window is topped up with the head of a piece that fits nowhere if that leaves ``min_cut`` ids on both
    sides; otherwise it is closed as it is. Memory per task: ``open_windows`` windows, one batch of texts and the ids of ``remembered`` words.
    Placement depends only on how files are split into tasks, so a task that is run again gives the same rows.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    fields = typed(docs, "doc_id") + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    ]
    schema = T.StructType([*fields, T.StructField("part", T.LongType()), T.StructField("ids", T.BinaryType())])
    arrow = _arrow(schema)

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer = encoder(tokenizer.value, remembered), Packer(length, open_windows, min_cut)
        out = _Out(arrow, part << 32, keep_ids)
        for batch, texts in texts_of(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = np.append(encode.ids(text), np.uint32(end_id))
                for window in packer.add(doc, ids, 0, len(ids)):
                    out.window(window)
                yield from out.flush(5000)
        for window in packer.rest():
            out.window(window, part)
        yield from out.flush()

    packed = stage(docs.select("doc_id", "text").mapInArrow(online, schema), "packing")
    done, left, level = [packed.where("part IS NULL")], packed.where("part IS NOT NULL"), 0
    parts = left.agg(F.max("part")).first()[0]
    while parts is not None:
        level, last = level + 1, parts < FAN_IN
        merge = _merger(length, open_windows, min_cut, keep_ids, level, last)
        merged = left.withColumn("part", F.expr(f"part DIV {FAN_IN}")).groupBy("part").applyInPandas(merge, schema)
        merged = stage(merged, f"packing-merge-{level}")
        done.append(merged.where("part IS NULL"))
        left, parts = merged.where("part IS NOT NULL"), None if last else parts // FAN_IN
    pieces = done[0]
    for more in done[1:]:
        pieces = pieces.unionByName(more)
    return pieces.drop("part", *([] if keep_ids else ["ids"]))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _merger(length: int, open_windows: int, min_cut: int, keep_ids: bool, level: int, last: bool):
    """Packs the leftovers of at most ``FAN_IN`` tasks, each at most ``open_windows`` windows."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        out = _Out(None, (level << 56) + (part << 32), keep_ids)
        rows = rows.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True], kind="stable")
        docs = [None if pd.isna(d) else d for d in rows["doc_id"]]
        raw = [np.frombuffer(b, "<u4") for b in rows["ids"]]
        packer = Packer(length, open_windows, min_cut)
        for doc, ids, start, doc_tokens in zip(docs, raw, rows["start"], rows["doc_tokens"]):
            for window in packer.add(doc, ids, int(start), int(doc_tokens)):
                out.window(window)
        rest = list(packer.rest())
        for window in _closed([p for w in rest for p in w], length) if last else rest:
            out.window(window, None if last else part)
        table = pd.DataFrame(out.rows, columns=list(rows.columns), dtype=object)
        return table

    return merge


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: its ids as an array, padded to ``length`` unless a power of two, and how many are real.

    ``pieces`` with ids, of which a sequence holds at most ``length``, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("tokens"))
    schema = "sequence_id long, tokens long, ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for parts in batch.column("parts").to_pylist():
                real = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
                n = len(real)
                ids.append(np.pad(real, (0, 0 if n & (n - 1) == 0 else length - n), constant_values=pad_id))
            columns = [batch.column("sequence_id"), batch.column("tokens"), pa.array(ids, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["sequence_id", "tokens", "ids"])

    return rows.select("sequence_id", F.col("parts.ids").alias("parts"), "tokens").mapInArrow(run, schema)
