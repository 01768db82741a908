"""Cuckoo filters over arrays of 64-bit hashes: whole arrays are looked up, added and removed at once."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MOST_ROUNDS = 500


class CuckooFilter:
    """16-bit prints of hashes in ``buckets`` (a power of two) of four slots; an added hash is always found.

    A hash has two buckets, each of which follows from the other and the print, so a print can move without its hash.
    Only hashes that were added may be removed, and each as often as it was added.
    """

    def __init__(self, buckets: int, cells: bytes | None = None):
        self.mask = np.uint64(buckets - 1)
        held = np.frombuffer(cells, "<u2").copy() if cells else np.zeros(buckets * SLOTS, "<u2")
        self.cells = held.reshape(buckets, SLOTS)

    @classmethod
    def from_bytes(cls, cells: bytes) -> CuckooFilter:
        return cls(len(cells) // (2 * SLOTS), cells)

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def _print(self, hashes: np.ndarray) -> np.ndarray:
        """1 to 65535, from the upper bits; buckets come from the lower ones."""
        return np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype("<u2")

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return hashes & self.mask

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        spread = prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
        return bucket ^ (spread & self.mask)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints = self._print(hashes)
        first = self._first(hashes)
        own = prints[:, None]
        return (self.cells[first] == own).any(axis=1) | (self.cells[self._other(first, prints)] == own).any(axis=1)

    def add(self, hashes: np.ndarray) -> None:
        """Adds every hash, in rounds: what finds no free slot goes to its other bucket and there takes a print's place."""
        prints = self._print(hashes)
        bucket = self._first(hashes)
        for turn in range(MOST_ROUNDS):
            if not len(prints):
                return
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            start = np.searchsorted(bucket, bucket)
            place = np.arange(len(bucket)) - start  # place among those of one bucket
            free = self.cells[bucket] == 0
            fits = place < free.sum(axis=1)
            rank = np.cumsum(free, axis=1) - 1
            slot = np.argmax(free & (rank == place[:, None]), axis=1)
            self.cells[bucket[fits], slot[fits]] = prints[fits]
            prints, bucket = prints[~fits], bucket[~fits]
            if turn:  # both buckets were full: one print of each bucket makes room and tries its other bucket
                lead = np.flatnonzero(np.diff(bucket, prepend=np.uint64(2**63)) != 0)
                victim = (bucket[lead] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(turn % 60)) % np.uint64(SLOTS)
                out = self.cells[bucket[lead], victim].copy()
                self.cells[bucket[lead], victim] = prints[lead]
                prints[lead] = out
            bucket = self._other(bucket, prints)
        raise OverflowError("the filter is too full")

    def remove(self, hashes: np.ndarray) -> None:
        """Removes one print of every hash."""
        prints, first = self._print(hashes), self._first(hashes)
        while len(prints):
            other = self._other(first, prints)
            here, there = self.cells[first] == prints[:, None], self.cells[other] == prints[:, None]
            found = here.any(axis=1)
            if not (found | there.any(axis=1)).all():
                raise KeyError("a hash to be removed was not added")
            bucket = np.where(found, first, other).astype(np.int64)
            slot = np.where(found, here.argmax(axis=1), there.argmax(axis=1))
            # equal prints may meet at one slot: each slot is emptied once, the others look again
            cells, lead = np.unique(bucket * SLOTS + slot, return_index=True)
            self.cells.reshape(-1)[cells] = 0
            left = np.ones(len(prints), bool)
            left[lead] = False
            prints, first = prints[left], first[left]
