"""Compression of vectors to one entry number per part, with Orchard search for the nearest entries.

Components become whole numbers, ``floor(1024 * x)``, and vectors are cut into
equal parts. Each part position has a codebook, which begins as that part of the
vectors with the smallest ids. A round assigns every part of every vector to its
nearest entry and moves each entry to the floored mean of its parts. Everything
is whole-number arithmetic, so results do not depend on how rows are dealt out.

The nearest entry is found with Orchard's method. Each entry has the list of all
entries by distance. A search walks the list of the best entry so far, jumps to
the list of a better one as soon as it meets one, and ends where the list passes
twice the best distance, as by the triangle inequality nothing beyond is nearer
(equal distances included). Entries are marked when visited. All vectors of a
batch search at once: those that stand at one place of one list look at its next
entries together.

Tasks get the codebooks only (parts x entries x width numbers), sum their own
vectors by entry, and send at most parts x entries rows into the shuffle, so a
vector that a third of all rows share costs no more than another.

Defined results: rows whose vector is null, empty, or holds a null or non-finite
component are dropped; equal ids are ordered by their vectors, null ids come
last; with fewer vectors than entries the codebooks are shorter; repeated rows
are coded each; no vectors give no rows. Vectors of unlike lengths, a length
that the parts do not divide, and components of 2**17 or more in magnitude (whose
summed error may not fit 64 bits) are errors. Other columns travel in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.hashing import gathered
from barflow.llm.shared import packed, require

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Components from which a scaled vector is refused.
LARGEST = 1 << 27
# Vectors that search at once, and bytes of a run of rows.
BATCH = 1 << 16
BATCH_BYTES = 64 << 20
# Entries, spread over the numbers, of which the nearest is where a search begins.
STARTS = 16
# Places of a neighbour list at which the first look ends; the next end at four times as many.
FIRST_LOOK = 16


class Codebook:
    """The entries of one part position, each with its distance-sorted list of all entries."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries, self.count = entries, len(entries)
        self.largest = int(np.abs(entries).max(initial=0))
        self.kind = self._kind(self.largest)
        self.reach, self.lists = self._neighbours(self.kind)

    def _kind(self, largest: int) -> type:
        """Doubles where every distance, times the number of entries, stays exact; Python's integers beyond."""
        return np.float64 if 4 * self.entries.shape[1] * largest**2 * max(self.count, 2) < 1 << 60 and largest < 1 << 23 else object

    def _neighbours(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        own = self.entries.astype(kind)
        square = (own * own).sum(axis=1)
        apart = square[:, None] - 2 * (own @ own.T) + square
        lists = np.argsort(apart, axis=1, kind="stable")
        return np.take_along_axis(apart, lists, axis=1), lists

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row (ties to the lower number) and its squared distance."""
        kind = self._kind(max(self.largest, int(np.abs(parts).max(initial=0))))
        reach = self.reach if kind is self.kind else self._neighbours(kind)[0]
        whole = np.int64 if kind is np.float64 else object
        own, entries = parts.astype(kind), self.entries.astype(kind)
        square, long = (own * own).sum(axis=1), (entries * entries).sum(axis=1)
        going, place = np.arange(len(parts)), np.zeros(len(parts), np.int64)
        visited = np.zeros((len(parts), self.count), bool)
        start = np.arange(0, self.count, -(-self.count // STARTS))
        visited[:, start] = True
        # distance * entries + number: smaller is nearer, or as near with the lower number
        ranks = (square[:, None] - 2 * (own @ entries[start].T) + long[start]).astype(whole) * self.count + start
        at = ranks.argmin(axis=1)
        rank, best = ranks[going, at], start[at]
        while True:
            going = going[place[going] < self.count]
            going = going[reach[best[going], place[going]] <= 4 * (rank[going] // self.count)]
            if not len(going):
                return best, (rank // self.count).astype(np.int64)
            stand = best[going] * self.count + place[going]
            order = np.argsort(stand, kind="stable")
            going, stand = going[order], stand[order]
            edges = np.append(np.flatnonzero(np.append(True, stand[1:] != stand[:-1])), len(going))
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                rows = going[low:high]
                entry, start = divmod(int(stand[low]), self.count)
                stop = max(4 * start, FIRST_LOOK)
                look = self.lists[entry, start:stop]
                place[rows] = stop
                fresh = rows[~visited[np.ix_(rows, look)].all(axis=1)]
                if not len(fresh):
                    continue
                visited[np.ix_(fresh, look)] = True
                apart = square[fresh][:, None] - 2 * (own[fresh] @ entries[look].T) + long[look]
                ranks = apart.astype(whole) * self.count + look
                at = ranks.argmin(axis=1)
                found = ranks[np.arange(len(fresh)), at]
                better = found < rank[fresh]
                moved = fresh[better]
                rank[moved], best[moved], place[moved] = found[better], look[at[better]], 0


@dataclass
class Codebooks:
    """Entries by part, number and position, as whole numbers."""

    entries: np.ndarray

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def length(self) -> int:
        return self.parts * self.entries.shape[2]

    def cut(self, vectors: np.ndarray) -> np.ndarray:
        """Parts of whole-number vectors, by part, row and position."""
        return vectors.reshape(len(vectors), self.parts, -1).transpose(1, 0, 2)

    def text(self) -> str:
        return ",".join(map(str, self.entries.ravel().tolist()))


def whole_numbers(vectors: pa.Array, length: int | None = None) -> np.ndarray:
    """Rows of scaled and floored components; all vectors must have one length."""
    if not len(vectors):
        return np.empty((0, length or 0), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = len(flat) // len(vectors)
    sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if (sizes != (length or width)).any():
        raise ValueError(f"vectors of unlike lengths: {sizes.min()} to {sizes.max()}, expected {length or width}")
    scaled = np.floor(flat * SCALE)
    if (np.abs(scaled) >= LARGEST).any():
        raise ValueError(f"components from {LARGEST // SCALE} on cannot be coded")
    return scaled.astype(np.int64).reshape(len(vectors), width)


def _whole(vector: str) -> Column:
    """Whether a vector has components and all of them are finite."""
    return F.expr(f"size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")


def _kept(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.filter(F.col(vector).isNotNull()).filter(F.coalesce(_whole(vector), F.lit(False)))


def _searched(batches: Iterator[pa.RecordBatch], at: int, books: Codebooks):
    """(batch, codes by part and row, squared distances likewise, parts) of runs of the batches."""
    search = [Codebook(e) for e in books.entries]
    for whole in gathered(batches, BATCH, BATCH_BYTES):
        for start in range(0, whole.num_rows, BATCH):
            batch = whole.slice(start, BATCH)
            parts = books.cut(whole_numbers(batch.column(at), books.length))
            found = [book.nearest(part) for book, part in zip(search, parts, strict=True)]
            yield batch, np.stack([f[0] for f in found]), np.stack([f[1] for f in found]), parts


def _sums(rows: DataFrame, books: Codebooks) -> list:
    """Number and component sums of the parts at each used entry; at most parts x entries rows."""
    width, sent = books.entries.shape[2], rows.sparkSession.sparkContext.broadcast(books)
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        counts, sums = np.zeros(books.entries.shape[:2], np.int64), np.zeros(books.entries.shape, np.int64)
        for _, codes, _, parts in _searched(batches, 0, books):
            for p, code in enumerate(codes):
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                counts[p] += np.bincount(code, minlength=counts.shape[1])
                if len(used):
                    sums[p, used] += np.add.reduceat(parts[p][order], first, axis=0)
        part, entry = np.nonzero(counts)
        found = sums[part, entry]
        columns = [pa.array(c) for c in (part, entry, counts[part, entry], *found.T)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *names])

    kinds = ", ".join(f"{c} bigint" for c in ("part", "entry", "n", *names))
    summed = rows.mapInArrow(run, kinds).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)])
    return summed.collect()


def learned_codebooks(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all vectors; None without vectors."""
    require(vectors, id, vector)
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    kept = _kept(vectors, vector).select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).toArrow().column("vector").combine_chunks()
    if not len(first):
        return None
    seeds = whole_numbers(first)
    if seeds.shape[1] % parts:
        raise ValueError(f"vectors of {seeds.shape[1]} components cannot be cut into {parts} parts")
    books = Codebooks(np.ascontiguousarray(seeds.reshape(len(seeds), parts, -1).transpose(1, 0, 2)))
    for _ in range(rounds):
        moved = books.entries.copy()
        for part, entry, n, *sums in _sums(kept.select("vector"), books):
            moved[part, entry] = np.array(sums, np.int64) // n
        books = Codebooks(moved)
    return books


def coded(vectors: DataFrame, books: Codebooks | None, vector: str = "embedding") -> DataFrame:
    """``row`` (the other columns), code (a byte per part) and error (summed squared distances) of each kept vector."""
    require(vectors, vector)
    rows = _kept(vectors, vector).select(packed(vectors.drop(vector)).alias("row"), F.col(vector).alias("vector"))
    kind = rows.schema["row"].dataType.simpleString()
    if books is None:
        none = rows.select("row", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return none.filter(F.lit(False))
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, codes, apart, _ in _searched(batches, 1, sent.value):
            spelled = [c.tobytes() for c in codes.T.astype(np.uint8)]
            error = pa.array(apart.sum(axis=0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spelled, pa.binary()), error], ["row", "code", "error"])

    return rows.mapInArrow(run, f"row {kind}, code binary, error bigint")


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """The columns of ``codes`` and ``vector``: the entries that its code names, scaled back."""
    require(codes, "code")
    sent, kind = codes.sparkSession.sparkContext.broadcast(books), codes.select(packed(codes).alias("row")).schema["row"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = sent.value.entries
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, len(entries))
            found = np.concatenate([e[c] for e, c in zip(entries, code.T, strict=True)], axis=1) / SCALE
            flat = pa.array(found.ravel())
            ends = pa.array(np.arange(len(code) + 1, dtype=np.int32) * found.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat)], ["row", "vector"])

    return codes.select(packed(codes).alias("row"), "code").mapInArrow(run, f"row {kind.simpleString()}, vector array<double>")
