"""Reversible line dedup: sharded cuckoo filters before exact reference counts.

A line's key is a 128-bit digest of the line without outer ASCII white space
and with A-Z lower-cased. The store keeps exact references (key, document), one
per document and key, and per shard a cuckoo filter over the keys that enough
documents hold. Documents are inserted and deleted by adding or taking away
their references; only keys that cross the limit change the filters, which
cuckoo filters allow in both directions. So deleting what was inserted brings
back the earlier decisions.

To drop lines, a document's keys go to their shard, and what the filter rejects
(nearly all) ends there; the rest meets the exact counts in a join, which
removes the filter's false positives. Counting combines on the map side, a
shard is read as a stream and salted, and a document's dropped keys are bounded
by its lines, so neither a line nor a shard that a third of all rows share
gathers in one task.

Defined results: null or empty text is one empty line and comes out empty; a null doc_id counts as
a document and as the smallest; repeated rows each count as a document and get
the same decision where their doc_id is the same; empty tables give no rows;
other columns travel in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.cuckoo import CuckooFilter
from barflow.llm.shared import packed, require, staged, utf8

MIN_CHARS = 40
MIN_DOCS = 5
# Keys of a shard's filter, on average, and parts into which a shard's references are dealt.
SHARD_KEYS = 1 << 16
SALTS = 8
STRIPPED = b" \t\n\x0b\x0c\r"
KEYS = "hi bigint, lo bigint"


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()


def _long(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points."""
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def _digests(text: bytes, least: int) -> list[bytes | None]:
    """Digest of each line's key, None for short ones."""
    keys = map(line_key, text.split(b"\n"))
    return [xxhash.xxh3_128_digest(k) if _long(k, least) else None for k in keys]


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, hi, lo): one row per document and key of sufficient length."""
    require(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [set(_digests(t, min_chars)) - {None} for t in batch.column(1).to_pylist()]
            at = np.repeat(np.arange(len(own)), [len(d) for d in own])
            pairs = np.frombuffer(b"".join(d for ds in own for d in ds), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())],
                ["doc_id", "hi", "lo"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", utf8("text").alias("text")).mapInArrow(run, f"doc_id {kind}, {KEYS}")


@dataclass
class LineStore:
    """References, counts of the keys that enough documents hold, and their filters, as written tables."""

    references: DataFrame
    frequent: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int

    def insert(self, docs: DataFrame, min_chars: int = MIN_CHARS) -> LineStore:
        """The store after documents were added."""
        new = self.references.unionByName(references(docs, min_chars))
        return self._moved(staged(new, "references"))

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """The store without the documents of these ids."""
        gone = doc_ids.select("doc_id").distinct()
        left = self.references.join(gone, self.references["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
        return self._moved(staged(left, "references"))

    def _moved(self, refs: DataFrame) -> LineStore:
        """Filters brought to new references: keys that crossed the limit go in or out.

        Where the shards have become too large, all are built anew under a larger number.
        """
        frequent = staged(_frequent(refs, self.min_docs), "frequent")
        keys = frequent.count()
        if keys > 2 * SHARD_KEYS * self.shards:
            return _built(refs, frequent, keys, self.min_docs)
        key = ["hi", "lo"]
        gained = frequent.join(self.frequent, key, "left_anti").select(*key, F.lit(True).alias("added"))
        lost = self.frequent.join(frequent, key, "left_anti").select(*key, F.lit(False).alias("added"))
        filters = _moved_filters(self.filters, gained.unionByName(lost), self.frequent, self.shards)
        return LineStore(refs, frequent, staged(filters, "filters"), self.shards, self.min_docs)


def line_store(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineStore:
    """The store of these documents."""
    refs = staged(references(docs, min_chars), "references")
    frequent = staged(_frequent(refs, min_docs), "frequent")
    return _built(refs, frequent, frequent.count(), min_docs)


def _built(refs: DataFrame, frequent: DataFrame, n_keys: int, min_docs: int) -> LineStore:
    """A store whose filters are made of all ``n_keys`` frequent keys."""
    shards = max(1, -(-n_keys // SHARD_KEYS))
    none = refs.sparkSession.createDataFrame([], "shard int, filter binary")
    keys = frequent.select("hi", "lo", F.lit(True).alias("added"))
    filters = staged(_moved_filters(none, keys, frequent.limit(0), shards), "filters")
    return LineStore(refs, frequent, filters, shards, min_docs)


def _frequent(refs: DataFrame, min_docs: int) -> DataFrame:
    """Keys that enough documents hold, with their number and the largest doc_id."""
    counts = refs.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
    return counts.filter(F.col("n_docs") >= min_docs)


def _shard(shards: int):
    return F.pmod(F.col("hi"), F.lit(shards)).cast("int").alias("shard")


def _moved_filters(filters: DataFrame, changes: DataFrame, held: DataFrame, shards: int) -> DataFrame:
    """Filters after keys were added and removed; ``held`` are the keys before, for a rebuild."""
    keys = changes.select(_shard(shards), "lo", F.col("added"), F.lit(False).alias("held"))
    before = held.select(_shard(shards), "lo", F.lit(True).alias("added"), F.lit(True).alias("held"))
    touched = keys.select("shard").distinct()
    keys = keys.unionByName(before.join(touched, "shard", "left_semi"))

    def move(old, new):
        shard = int((old if len(old) else new)["shard"].iloc[0])
        held = new["held"].to_numpy()
        lows, added = new["lo"].to_numpy().astype(np.uint64), new["added"].to_numpy().astype(bool)
        gone = lows[~held & ~added]
        made = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else None
        if made is not None:
            made.delete(gone)
        if made is None or not made.insert(np.setdiff1d(lows[~held & added], gone)):
            made = CuckooFilter.of(np.setdiff1d(np.unique(lows[added]), gone))
        return pd.DataFrame({"shard": [shard], "filter": [made.to_bytes()]})

    return filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(move, "shard int, filter binary")


def _suspects(store: LineStore, refs: DataFrame) -> DataFrame:
    """References whose key passes its shard's filter."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    rows = refs.select(_shard(store.shards), salt.alias("salt"), F.lit(None).cast("binary").alias("filter"), "doc_id", "hi", "lo")
    kind = refs.schema["doc_id"].dataType.simpleString()
    filters = store.filters.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
        "filter",
        F.lit(None).cast(kind).alias("doc_id"),
        F.lit(None).cast("bigint").alias("hi"),
        F.lit(None).cast("bigint").alias("lo"),
    )
    parts = max(store.shards * SALTS, int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = filters.unionByName(rows).repartition(parts, "shard", "salt")
    ordered = dealt.sortWithinPartitions("shard", "salt", F.col("filter").isNull())

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            shard, salt = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ends = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0)) + 1
            for start, end in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows], strict=True):
                if start == end:
                    continue
                if at != (shard[start], salt[start]):
                    at, held = (shard[start], salt[start]), None
                if batch.column(2)[start].is_valid:
                    held = CuckooFilter.from_bytes(batch.column(2)[start].as_py())
                    start += 1
                if held is None or start == end:
                    continue
                part = batch.slice(start, end - start)
                found = held.contains(part.column(5).to_numpy().astype(np.uint64))
                yield part.select([3, 4, 5]).filter(pa.array(found))

    return ordered.mapInArrow(probe, f"doc_id {kind}, {KEYS}")


def dropped_keys(store: LineStore, refs: DataFrame) -> DataFrame:
    """(doc_id, dropped): per document the keys whose lines go."""
    exact = _suspects(store, refs).join(store.frequent, ["hi", "lo"])
    later = F.coalesce(F.col("doc_id") < F.col("last_doc"), F.col("last_doc").isNotNull())
    return exact.filter(later).groupBy("doc_id").agg(F.collect_set(F.struct("hi", "lo")).alias("dropped"))


def dedup_lines(docs: DataFrame, store: LineStore | None = None, min_chars: int = MIN_CHARS) -> DataFrame:
    """``row`` (all columns), n_lines, n_dropped and the kept text of each document.

    Without a store the documents are held against themselves.
    """
    require(docs, "doc_id", "text")
    if store is None:
        store = line_store(docs, min_chars)
        refs = store.references
    else:
        refs = references(docs, min_chars)
    gone = staged(dropped_keys(store, refs), "dropped").withColumnRenamed("doc_id", "of")
    rows = docs.select(packed(docs.drop("text")).alias("row"), docs["doc_id"].alias("doc_id"), utf8("text").alias("text"))
    # What is dropped grows with the documents, so it is never broadcast, also where it happens to be small.
    gone = gone.hint("merge")
    joined = rows.join(gone, rows["doc_id"].eqNullSafe(gone["of"]), "left").select("row", "text", "dropped")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, kept = [], [], []
            for text, keys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n_lines, n_kept = text.count(b"\n") + 1, None
                if keys:
                    bad = {np.array([k["hi"], k["lo"]], "<i8").tobytes() for k in keys}
                    pairs = zip(text.split(b"\n"), _digests(text, min_chars), strict=True)
                    left = [line for line, digest in pairs if digest not in bad]
                    n_kept, text = len(left), b"\n".join(left)
                lines.append(n_lines)
                dropped.append(0 if n_kept is None else n_lines - n_kept)
                kept.append(text)
            out = [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], ["row", "n_lines", "n_dropped", "kept"])

    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {kind}, n_lines bigint, n_dropped bigint, kept binary")


def deduped(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without their dropped lines, with their own columns."""
    out = dedup_lines(docs, min_chars=min_chars)
    text = F.col("kept").cast("string")
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias(name))
        elif name == "n_chars":
            count = F.length(text).cast(docs.schema[name].dataType)
            columns.append(F.when(F.col("n_dropped") > 0, count).otherwise(F.col("row.n_chars")).alias(name))
        else:
            columns.append(F.col("row")[name].alias(name))
    return out.select(*columns)
