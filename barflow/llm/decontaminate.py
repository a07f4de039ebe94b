"""Benchmark decontamination as a prefix-filtered set join.

Items are cut into windows (shingles of up to ten consecutive words). The words
of a window are ordered by rarity, counted over all documents; to contain the
window a text must hold its rarest word, so one prefix token is enough. A text
word that is some window's prefix token gives candidate starts from the token's
offsets in windows (positional bound), kept where the window fits into the text
(length bound) and where its hash is known. Candidates carry their words and
are joined with the windows on them, which verifies the containment exactly.

What tasks are sent are bit tables of a fixed size over hash buckets: a larger
benchmark fills them more and lets more candidates through to the exact join,
but they never grow. Candidates of a hot window are joined by Spark, which
splits them; what is gathered per document is bounded by its own length.

Defined results: null texts and items have no words; an item with a null id
marks words but is not listed; repeated rows are judged each; without items no
word is hit; empty documents give an empty table. Other columns travel in
``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.hashing import FACTOR, WordHashes, gram_hashes, mixed, slices
from barflow.llm.shared import packed, require, staged, utf8

WINDOW = 10
BUCKETS = 1 << 20
WINDOW_BITS = 1 << 22

# ASCII letters lower-cased, digits and bytes from 0x80 as they are, the rest spaces.
CLEAN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(CLEAN).split() if text else []


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _item_windows(items: DataFrame, size: int) -> DataFrame:
    """(item_id, n, window): the distinct windows of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                own = words(text)
                if own:
                    n = min(size, len(own))
                    grams = {b" ".join(own[i : i + n]) for i in range(len(own) - n + 1)}
                    ids += [at] * len(grams)
                    found += grams
            lengths = pa.array([g.count(b" ") + 1 for g in found], pa.int32())
            picked = batch.column(0).take(pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays([picked, lengths, pa.array(found, pa.binary())], ["item_id", "n", "window"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", utf8("text").alias("text")).mapInArrow(cut, f"item_id {kind}, n int, window binary")


def _vocabulary(windows: DataFrame) -> np.ndarray:
    """Buckets that hold a word of some window; at most BUCKETS rows come to the driver."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = {w for g in batch.column(0).to_pylist() for w in g.split(b" ")}
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_bucket(hashes.of(list(found)))))], ["bucket"])

    rows = windows.select("window").mapInArrow(buckets, "bucket bigint").distinct()
    held = np.zeros(BUCKETS, bool)
    held[rows.toArrow().column(0).to_numpy()] = True
    return held


def _rarity(docs: DataFrame, held) -> np.ndarray:
    """How often the words of each held bucket stand in all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, 0):
            own = [w for text in batch.column(0).to_pylist() for w in words(text)]
            total += np.bincount(_bucket(hashes.of(own)), minlength=BUCKETS)
        at = np.flatnonzero((total > 0) & held.value)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = docs.select(utf8("text").alias("text")).mapInArrow(counted, "bucket bigint, n bigint")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS, np.int64)
    total[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return total


def _prefixes(windows: DataFrame, rarity) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Per window length, the offsets (as bits) of each bucket's prefix tokens; and the known window hashes."""

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for n, window in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = hashes.of(window.split(b" "))
                at = _bucket(own)
                offset = int(np.lexsort((at, rarity.value[at]))[0])
                bit = int(gram_hashes(own, n)[0] & np.uint64(WINDOW_BITS - 1))
                out.append((n, int(at[offset]), 1 << offset, bit))
            columns = [pa.array(c) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([columns[0].cast(pa.int32()), *columns[1:]], ["n", "bucket", "offset", "bit"])

    rows = windows.select("n", "window").distinct().mapInArrow(rarest, "n int, bucket bigint, offset bigint, bit bigint")
    rows = staged(rows, "prefixes")
    found = rows.groupBy("n", "bucket").agg(F.bit_or("offset").alias("offsets")).toArrow()
    tables: dict[int, np.ndarray] = {}
    n, at, offsets = (found.column(c).to_numpy() for c in ("n", "bucket", "offsets"))
    for length in np.unique(n).tolist():
        tables[length] = np.zeros(BUCKETS, np.uint16)
        tables[length][at[n == length]] = offsets[n == length].astype(np.uint16)
    known = np.zeros(WINDOW_BITS, bool)
    known[rows.select("bit").distinct().toArrow().column(0).to_numpy()] = True
    return tables, known


def _candidates(own: np.ndarray, doc_of: np.ndarray, tables: dict, known: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the places that pass the prefix, position, length and hash tests."""
    out = []
    at = _bucket(own)
    for n, offsets in tables.items():
        bits = offsets[at]
        tokens = np.flatnonzero(bits)
        starts = [tokens[(bits[tokens] >> np.uint16(o)) & 1 == 1] - o for o in range(n)]
        start = np.unique(np.concatenate(starts))
        start = start[(start >= 0) & (start + n <= len(own))]
        start = start[doc_of[start] == doc_of[start + n - 1]]
        whole = own[start]
        for i in range(1, n):
            whole = whole * FACTOR + own[start + i]
        start = start[known[(mixed(whole) & np.uint64(WINDOW_BITS - 1)).astype(np.int64)]]
        out += [(s, n) for s in start.tolist()]
    return out


def _scanned(docs: DataFrame, row, tables, known) -> DataFrame:
    """row, n_words and the candidates of each document."""
    index = docs.sparkSession.sparkContext.broadcast((tables, known))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        tables, known = index.value
        for batch in slices(batches, 1):
            own = [words(t) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(w) for w in own], np.int64)
            first = np.cumsum(sizes) - sizes
            all_words = [w for ws in own for w in ws]
            doc_of = np.repeat(np.arange(len(own)), sizes)
            found: list[list[dict]] = [[] for _ in own]
            for start, n in _candidates(hashes.of(all_words), doc_of, tables, known):
                doc = int(doc_of[start])
                text = b" ".join(all_words[start : start + n])
                found[doc].append({"start": start - int(first[doc]), "n": n, "window": text})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int32()), ("window", pa.binary())]))
            columns = [batch.column(0), pa.array(sizes), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "found"])

    rows = docs.select(row.alias("row"), utf8("text").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(scan, f"row {kind}, n_words bigint, found array<struct<start:bigint,n:int,window:binary>>")


COVERED = """
aggregate(array_sort(spans), struct(0L AS n, 0L AS reach), (a, s) ->
  struct(a.n + greatest(0L, s.start + s.n - greatest(a.reach, s.start)) AS n,
         greatest(a.reach, s.start + s.n) AS reach), a -> a.n)
"""


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, whole_rows: bool = False) -> DataFrame:
    """``row`` (the other columns; with ``whole_rows`` all), n_words, n_hit and the items as a sorted list of strings."""
    require(docs, "text")
    require(items, "item_id", "text")
    if not 1 <= size <= 16:
        raise ValueError("a window has 1 to 16 words")
    spark = docs.sparkSession
    windows = staged(_item_windows(items, size), "windows")
    held = spark.sparkContext.broadcast(_vocabulary(windows))
    rarity = spark.sparkContext.broadcast(_rarity(docs, held))
    tables, known = _prefixes(windows, rarity)
    row = packed(docs if whole_rows else docs.drop("text"))
    scanned = staged(_scanned(docs, row, tables, known).withColumn("rid", F.monotonically_increasing_id()), "scanned")
    places = scanned.select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    hits = places.join(windows, ["n", "window"])
    per_doc = hits.groupBy("rid").agg(
        F.collect_set(F.struct("start", "n")).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    per_doc = per_doc.select("rid", F.expr(COVERED).alias("n_hit"), "items")
    return scanned.join(per_doc, "rid", "left").select(
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no item's window occurs, with their own columns."""
    clean = contamination(docs, items, size, whole_rows=True).filter("n_hit = 0")
    return clean.select(*[F.col("row")[c].alias(c) for c in docs.columns])
