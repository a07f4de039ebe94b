"""A cuckoo filter over 64-bit keys: approximate membership that supports deletion."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """16-bit fingerprints in buckets of four; no false negatives, about 1 in 8000 false positives.

    A key may be inserted once only; a full table doubles by rebuilding, for
    which ``grow`` asks the caller (who has the exact table) for the keys.
    """

    def __init__(self, capacity: int) -> None:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(capacity, 1) / (SLOTS * 0.9)))))
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        self.seed = 0

    @property
    def mask(self) -> int:
        return len(self.table) - 1

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(self.mask)
        keys = keys.astype(np.uint64)
        prints = ((keys >> np.uint64(48)) % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)
        first = keys & mask
        return prints, first.astype(np.int64), (first ^ self._jump(prints)).astype(np.int64)

    def _jump(self, prints: np.ndarray) -> np.ndarray:
        spread = prints.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995)
        return (spread >> np.uint64(20)) & np.uint64(self.mask)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(keys)
        same = (self.table[one] == prints[:, None]) | (self.table[two] == prints[:, None])
        return same.any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if a key found no place; the filter must then be rebuilt larger."""
        rng = np.random.default_rng(len(self.table))
        prints, one, two = self._places(keys)
        jumps = self._jump(np.arange(0x10000, dtype=np.uint64).astype(np.uint16))
        for mark, a, b in zip(prints.tolist(), one.tolist(), two.tolist(), strict=True):
            at = a if not self.table[a].all() else b
            for _ in range(MAX_KICKS):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = mark
                    break
                slot = int(rng.integers(SLOTS))
                mark, self.table[at, slot] = int(self.table[at, slot]), mark
                at ^= int(jumps[mark])
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted before."""
        prints, one, two = self._places(keys)
        for mark, a, b in zip(prints.tolist(), one.tolist(), two.tolist(), strict=True):
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == mark)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        capacity = len(keys)
        while True:
            made = cls(capacity)
            if made.insert(keys):
                return made
            capacity = capacity * 2 + 8

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        made = cls(1)
        made.table = np.frombuffer(data, "<u2").astype(np.uint16).reshape(-1, SLOTS)
        return made
