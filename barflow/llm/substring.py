"""Substring dedup with suffix automata of reference shards.

A word goes if a window of ``length`` words that covers it also starts in a
document with a smaller doc_id. Broadcasting automata of all documents to all
documents would cost shards times documents, and their size has no bound; so
what meets is routed by content. Each window has an anchor: the smallest hash of
the 20-word grams inside it. Equal windows have equal anchors, and neighbouring
windows mostly share one, so a document falls into runs of windows with a common
anchor. Anchors of one document only are done with; the runs of the others go,
with their words, to the shard of their anchor. There the spans come in order
of doc_id, each is streamed through the suffix automaton of the spans of
smaller ids for its matching statistics, and windows whose match reaches
``length`` are returned as intervals; then the span is added. A shard holds
the automaton of one anchor at a time.

An anchor with more than ``HOT`` runs (a passage that very many documents
hold) would make a shard too long. Its windows are dealt out singly, each under
its own 128-bit digest (once per document), where the smallest doc_id is found
with map-side aggregation: what is left of the automaton for one window is
equality.

Defined results: null text has no words; a null doc_id sorts before all others
and equal ids are not earlier than each other, so repeated rows keep the same
words; texts shorter than a window keep all words; empty tables give no rows;
other columns travel in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.automaton import SuffixAutomaton
from barflow.llm.hashing import WordHashes, gram_hashes, sliding_min
from barflow.llm.shared import packed, require, staged, utf8

LENGTH = 50
GRAM = 20
# Windows of a run at most (a longer one is cut, which changes no result).
RUN = 64
# Runs with one anchor above which its windows are dealt out singly.
HOT = 2000
LEAST = -(1 << 63)


def runs(words: list[bytes], hashes: WordHashes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of each run of windows with one anchor."""
    if len(words) < length:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none
    gram = min(GRAM, length)
    anchors = sliding_min(gram_hashes(hashes.of(words), gram), length - gram + 1)
    starts = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
    sizes = np.diff(np.append(starts, len(anchors)))
    if sizes.max() > RUN:
        starts = np.concatenate([np.arange(s, s + n, RUN) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)])
        sizes = np.diff(np.append(starts, len(anchors)))
    return anchors[starts], starts, sizes


def _runs(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, ord, mark, place) of each run; place is 128 times the first window plus the number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [runs(t.split(), hashes, length) for t in batch.column(2).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            anchor = np.concatenate([f[0] for f in found]).view(np.int64)
            place = np.concatenate([f[1] * 128 + f[2] for f in found]).astype(np.int64)
            columns = [pa.array(anchor), batch.column(0).take(at), batch.column(1).take(at), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "ord", "mark", "place"])

    return docs.select("ord", "mark", "text").mapInArrow(run, "anchor bigint, ord bigint, mark bigint, place bigint")


def _spans(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Words of the wanted runs: whole spans, or digests of single windows where the anchor is hot."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hot", "hi", "lo", "ord", "mark", "starts", "span"]
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for ord_, mark, text, places in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = text.split()
                singles: dict[bytes, list[int]] = {}
                for item in places:
                    start, n = item["place"] >> 7, item["place"] & 127
                    if item["hot"]:
                        for i in range(start, start + n):
                            digest = xxhash.xxh3_128_digest(b" ".join(words[i : i + length]))
                            singles.setdefault(digest, []).append(i)
                    else:
                        span = b" ".join(words[start : start + n + length - 1])
                        for column, value in zip(out, (False, item["anchor"], 0, ord_, mark, [start], span), strict=True):
                            column.append(value)
                # a document repeats no window here, however often its text does
                for digest, starts in singles.items():
                    hi, lo = np.frombuffer(digest, "<i8").tolist()
                    for column, value in zip(out, (True, hi, lo, ord_, mark, starts, None), strict=True):
                        column.append(value)
                if len(out[0]) > 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    key = ["ord", "mark"]
    per_doc = wanted.groupBy(*key).agg(F.collect_set(F.struct("place", "anchor", "hot")).alias("places"))
    # what is wanted grows with the documents, so it is never broadcast
    rows = docs.select("ord", "mark", "text").join(per_doc.hint("merge"), key).select("ord", "mark", "text", "places")
    return rows.mapInArrow(
        cut, "hot boolean, hi bigint, lo bigint, ord bigint, mark bigint, starts array<bigint>, span binary"
    )


def repeats(spans: list[tuple[int, list[bytes]]], length: int) -> list[list[tuple[int, int]]]:
    """Per span (ord, words), sorted by ord: intervals of its windows that a smaller ord holds."""
    known: set[tuple[bytes, ...]] = set()
    automaton = SuffixAutomaton()
    found = []
    for _, same in groupby(spans, key=lambda s: s[0]):
        fresh = []
        for _, words in same:
            whole = tuple(words)
            if whole in known:
                found.append([(0, len(words) - length + 1)])
                continue
            fresh.append(whole)
            marks = [held >= length for held in automaton.matching(words)][length - 1 :] if known else []
            edges = np.flatnonzero(np.diff(np.concatenate([[0], marks, [0]])))
            found.append([tuple(pair) for pair in edges.reshape(-1, 2).tolist()])
        for whole in fresh:
            if whole not in known:
                automaton.add(whole)
                known.add(whole)
    return found


def _matched(spans: DataFrame, length: int) -> DataFrame:
    """(ord, mark, a, b): intervals of windows, from the shards of the anchors."""
    parts = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = spans.select("hi", "ord", "mark", F.col("starts")[0].alias("start"), "span").repartition(parts, "hi")
    ordered = dealt.sortWithinPartitions("hi", "ord")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int]] = []
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            held = list(group)
            hits = repeats([(r[1], r[4].split(b" ")) for r in held], length)
            out += [(r[1], r[2], r[3] + a, r[3] + b) for r, own in zip(held, hits, strict=True) for a, b in own]
            if len(out) > 5000:
                yield _quads(out)
                out = []
        yield _quads(out)

    return ordered.mapInArrow(match, "ord bigint, mark bigint, a bigint, b bigint")


def _quads(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    table = np.array(rows, np.int64).reshape(-1, 4)
    return pa.RecordBatch.from_arrays([pa.array(table[:, i].copy()) for i in range(4)], ["ord", "mark", "a", "b"])


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(ord, mark, a, b): the windows a <= i < b of a document occur in one with a smaller ord."""
    own = staged(_runs(docs, length), "runs")
    shared = own.groupBy("anchor").agg(F.min("ord").alias("low"), F.max("ord").alias("high"), F.count(F.lit(1)).alias("n"))
    shared = shared.filter("low < high").select("anchor", (F.col("n") > HOT).alias("hot"))
    spans = staged(_spans(docs, own.join(shared, "anchor"), length), "spans")
    matched = _matched(spans.filter("NOT hot"), length)
    windows = spans.filter("hot").select("hi", "lo", "ord", "mark", "starts")
    first = windows.groupBy("hi", "lo").agg(F.min("ord").alias("low"), F.max("ord").alias("high")).filter("low < high")
    singles = windows.join(first.drop("high"), ["hi", "lo"]).filter("ord > low")
    singles = singles.select("ord", "mark", F.explode("starts").alias("a"))
    return matched.unionByName(singles.withColumn("b", F.col("a") + 1))


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row`` (the other columns), n_words, n_removed and the kept words joined by one space."""
    require(docs, "doc_id", "text")
    rows = docs.select(
        packed(docs.drop("text")).alias("row"),
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LEAST)).alias("ord"),
        utf8("text").alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    found = staged(repeated_windows(rows, length), "repeats")
    per_doc = found.groupBy("ord", "mark").agg(F.collect_set(F.struct("a", "b")).alias("hits"))
    joined = rows.join(per_doc.hint("merge"), ["ord", "mark"], "left").select("row", "text", "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = text.split()
                counts.append(len(words))
                if hits:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [h["a"] for h in hits], 1)
                    np.add.at(change, [h["b"] + length - 1 for h in hits], -1)
                    stays = np.cumsum(change)[:-1] == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            out = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], ["row", "n_words", "n_removed", "kept"])

    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {kind}, n_words bigint, n_removed bigint, kept binary")
