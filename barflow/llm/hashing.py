"""Word hashes and sliding windows inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash

# Words that a worker's cache holds before it is emptied.
CACHE_WORDS = 250_000
# Text bytes that are worked on at once.
SLICE_BYTES = 4 << 20


class WordHashes(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a polynomial hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    count = len(hashes) - n + 1
    out = hashes[:count].copy()
    for i in range(1, n):
        out *= FACTOR
        out += hashes[i : i + count]
    return mixed(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, done = values, 1
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        rest = width - done
        out = np.minimum(out[:-rest], out[rest:])
    return out


def gathered(batches: Iterator[pa.RecordBatch], rows: int, size: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Join small batches to ones of at least ``rows`` rows or ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Cut batches where their texts exceed SLICE_BYTES; a longer text stands alone."""
    for batch in batches:
        start, held = 0, 0
        for i, size in enumerate(pa.compute.binary_length(batch.column(text)).to_pylist()):
            if held and held + (size or 0) > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)
