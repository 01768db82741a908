"""Fill-in-the-middle texts from seekable frames.

Two cuts between lines, drawn by a digest of the id, part a text into prefix, middle and suffix, which are written in
another order behind marks. Texts are stored as compressed frames; only the frames that hold a cut are opened to make
the output, which is a list of frames again, and digests are taken frame by frame.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rosterflow.llm.common import typed
from rosterflow.llm.frames import Frames, code_points, pack, pieces, units_of, unpack

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARK = re.compile(rb"<[PSM]>")
_LONGS = pa.list_(pa.int64())
_STORED = ["frames", "byte_ends", "char_ends", "newline_ends", "n", "marked"]


def _schema(docs: DataFrame, others: list[str], added: str) -> T.StructType:
    return T.StructType([*typed(docs, *others), *T.StructType.fromDDL(added).fields])


def store(docs: DataFrame) -> DataFrame:
    """Every column but the text, and the text as ``frames`` with running counts; n: its lines, marked: holds a mark.

    A null text is empty and has no frames. Columns of the names used here are replaced.
    """
    others = [c for c in docs.columns if c not in ("text", *_STORED)]
    longs = [f"{c} array<long>" for c in _STORED[1:4]]
    schema = _schema(docs, others, f"frames array<binary>, {', '.join(longs)}, n long, marked boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_stored(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            kinds = [pa.list_(pa.binary()), _LONGS, _LONGS, _LONGS, pa.int64(), pa.bool_()]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.record_batch([*(batch.column(c) for c in others), *columns], names=schema.names)

    return docs.mapInArrow(run, schema)


def _stored(text: bytes) -> tuple:
    frames, ends = [], ([], [], [])
    totals = [0, 0, 0]
    for piece in pieces(text):
        frames.append(pack(piece))
        for i, n in enumerate((len(piece), code_points(piece), piece.count(b"\n"))):
            totals[i] += n
            ends[i].append(totals[i])
    return frames, *ends, units_of(text), _MARK.search(text) is not None


def _numbers(doc_id, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _moved(doc_id, text: Frames, n: int, marked: bool, seed: int, rate: int, spm: int) -> tuple:
    """(form, prefix_chars, middle_chars, frames of the output)."""
    h1, h2, h3, h4 = _numbers(doc_id, seed)
    if n == 0 or marked or h3 % 100 >= rate:
        return "plain", None, None, text.frames
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    start, a, b, end = (0, 0), text.after_line(first), text.after_line(last), (len(text.frames), 0)
    if last == n:
        b = end
    if first == n:
        a = end
    prefix_chars = text.chars_before(a)
    middle_chars = text.chars_before(b) - prefix_chars
    prefix, middle, suffix = text.between(start, a), text.between(a, b), text.between(b, end)
    if h4 % 100 < spm:
        order = ("spm", (SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle))
    else:
        order = ("psm", (PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle))
    form, *parts = order
    return form, prefix_chars, middle_chars, [f for mark, frames in parts for f in (pack(mark), *frames)]


def transform(stored: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """Stored rows with form, prefix_chars, middle_chars and the output as ``output`` frames instead of the text's.

    ``rate`` and ``spm`` are hundredths: of texts that are transformed, and of those that put the suffix first. Texts
    that are empty or hold a mark are left plain, with null counts. A null id draws like an empty one; rows of equal id
    and text come out alike. Long texts are held compressed, a few frames open; an empty table gives no rows. Columns
    of other names stay.
    """
    added = ["form", "prefix_chars", "middle_chars", "output"]
    others = [c for c in stored.columns if c not in (*_STORED, *added)]
    schema = _schema(stored, ["n", *others], "form string, prefix_chars long, middle_chars long, output array<binary>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, marked = (batch.column(c).to_pylist() for c in ("doc_id", "n", "marked"))
            frames = batch.column("frames").to_pylist()
            chars, newlines = (batch.column(c).to_pylist() for c in ("char_ends", "newline_ends"))
            texts = [Frames(f, {"chars": c, "newlines": e}) for f, c, e in zip(frames, chars, newlines)]
            rows = [_moved(*row, seed, rate, spm) for row in zip(ids, texts, n, marked)]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            kept = [batch.column(c) for c in ("n", *others)]
            yield pa.record_batch([*kept, *columns], names=schema.names)

    return stored.mapInArrow(run, schema)


def parts(form: str, output: Frames) -> list[tuple[int, int]]:
    """Byte ranges of prefix, middle and suffix in an output, by its marks alone; of a plain text one range."""
    size = output.ends["bytes"][-1] if output.frames else 0
    if form == "plain":
        return [(0, size)]
    found, tail, base = [], b"", 0
    for i in range(len(output.frames)):
        data = tail + output.read(i)
        found += [(m.group(), base - len(tail) + m.start()) for m in _MARK.finditer(data)]
        base += len(data) - len(tail)
        # a mark may begin in one frame and end in the next; two bytes cannot hold a whole one
        tail = data[-2:]
    ends = [at for _, at in found[1:]] + [size]
    ranges = {mark: (at + len(mark), end) for (mark, at), end in zip(found, ends)}
    return [ranges[mark] for mark in (PREFIX, MIDDLE, SUFFIX)]


def restore(form: str, output: Frames) -> Iterator[bytes]:
    """The text that an output was made of, frame by frame, from the output and its form alone."""
    for start, end in parts(form, output):
        yield from output.stream(start, end)


def _digest(data: Iterator[bytes]) -> str:
    sha = hashlib.sha256()
    for piece in data:
        sha.update(piece)
    return sha.hexdigest()


def digests(moved: DataFrame) -> DataFrame:
    """Transformed rows with output_sha256 and restored_sha256 instead of the output's frames."""
    added = ["output_sha256", "restored_sha256"]
    others = [c for c in moved.columns if c not in ("output", *added)]
    schema = _schema(moved, others, "output_sha256 string, restored_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for form, frames in zip(batch.column("form").to_pylist(), batch.column("output").to_pylist()):
                output = Frames.of(frames)
                whole = _digest(map(output.read, range(len(frames))))
                rows.append((whole, _digest(restore(form, output))))
            columns = [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]
            yield pa.record_batch([*(batch.column(c) for c in others), *columns], names=schema.names)

    return moved.mapInArrow(run, schema)


def texts(moved: DataFrame) -> DataFrame:
    """Transformed rows with the output as one string column ``text`` instead of frames."""
    others = [c for c in moved.columns if c not in ("output", "text")]
    schema = _schema(moved, others, "text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [b"".join(map(unpack, frames)) for frames in batch.column("output").to_pylist()]
            text = pa.array(whole, pa.binary()).cast(pa.string())
            yield pa.record_batch([*(batch.column(c) for c in others), text], names=schema.names)

    return moved.mapInArrow(run, schema)
