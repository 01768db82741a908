"""Texts as seekable frames: independent zstandard frames with cumulative counts.

A text is cut into frames of at most FRAME bytes, each compressed on its own. Running counts of bytes, code points and
line ends say which frame holds a given line end, so a piece of a text is found by opening one frame at each of its
ends; frames between them are passed on as they are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import zstandard

FRAME = 1 << 16
#: frames of one text that are held open at once
OPEN = 8


@lru_cache(1)
def _codecs() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(data: bytes) -> bytes:
    return _codecs()[0].compress(data)


def unpack(frame: bytes) -> bytes:
    return _codecs()[1].decompress(frame)


def code_points(data: bytes) -> int:
    return len(data.decode("utf-8"))


def pieces(data: bytes, size: int = FRAME) -> Iterator[bytes]:
    """Pieces of at most ``size`` bytes (a code point more at most four), cut between code points."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[at:end]
        at = end


def units_of(data: bytes) -> int:
    """Lines of a text with their line ends; what follows the last line end is one more, if anything does."""
    return data.count(b"\n") + (len(data) > 0 and data[-1] != 10)


class Frames:
    """Frames of one text, of which a few are held open."""

    def __init__(self, frames: list[bytes], ends: dict[str, list[int]]):
        self.frames, self.ends, self._open = frames, ends, {}

    @classmethod
    def of(cls, frames: list[bytes]) -> Frames:
        """Frames whose sizes are counted by opening them one after another."""
        made = cls(frames, {"bytes": []})
        total = 0
        for i in range(len(frames)):
            total += len(made.read(i))
            made.ends["bytes"].append(total)
        return made

    def read(self, i: int) -> bytes:
        data = self._open.get(i)
        if data is None:
            data = unpack(self.frames[i])
            if len(self._open) >= OPEN:
                self._open.pop(next(iter(self._open)))
            self._open[i] = data
        return data

    def after_line(self, k: int) -> tuple[int, int]:
        """(frame, byte in it) behind the k-th line; the end of the text if it has fewer line ends."""
        if k <= 0:
            return 0, 0
        i = bisect_left(self.ends["newlines"], k)
        if i == len(self.frames):
            return i, 0
        inside = k - (self.ends["newlines"][i - 1] if i else 0)
        at = np.flatnonzero(np.frombuffer(self.read(i), np.uint8) == 10)[inside - 1]
        return i, int(at) + 1

    def chars_before(self, place: tuple[int, int]) -> int:
        i, at = place
        chars = self.ends["chars"]
        whole = chars[i - 1] if i else 0
        return whole + (code_points(self.read(i)[:at]) if at else 0)

    def between(self, a: tuple[int, int], b: tuple[int, int]) -> Iterator[bytes]:
        """Frames of the piece from ``a`` to ``b``: whole ones as they are, the cut ones made anew."""
        (i, p), (j, q) = a, b
        if i == j:
            if q > p:
                yield pack(self.read(i)[p:q])
            return
        yield pack(self.read(i)[p:]) if p else self.frames[i]
        yield from self.frames[i + 1 : j]
        if q:
            yield pack(self.read(j)[:q])

    def stream(self, start: int, end: int) -> Iterator[bytes]:
        """Bytes ``start`` to ``end`` of the text, frame by frame."""
        ends = self.ends["bytes"]
        i = bisect_left(ends, start + 1)
        while start < end:
            base = ends[i - 1] if i else 0
            yield self.read(i)[start - base : end - base]
            start, i = ends[i], i + 1
