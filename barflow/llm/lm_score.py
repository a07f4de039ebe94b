"""Stupid-backoff scores of documents, from n-gram counts over the whole corpus.

Every word and every n-gram up to the order has a 64-bit key (two of them share
one with a chance of one in 2**64) and an exact count: there is no vocabulary
and nothing is cut or broadcast, so what is gathered grows with the corpus.

Documents are taken in slices of some megabytes, written as numbers of words. A
slice sends each partition of the keys its different n-grams there, once, with
how often it has them; so a word of every second text is one number per slice,
and no partition is hot. A partition sums them to its count table, joins the
table to the n-grams of each slice and answers in their order, a byte each where
counts are small. The answers meet in their slice, where the logarithms are
summed per document. The n-grams of all documents are several times the input,
so the keys are worked on in ROUNDS ranges, one after the other, and the answers
of each are written, after which its shuffle files go.

A count of an n-gram leaves out the document's own, or nothing would ever back
off: ``S(c|ab) = (c(abc) - own) / c(ab)`` where that is positive, else ``0.4 *
S(c|b)``; a word alone is ``c(c)`` over all words. Words at the start of a
document have the shorter context that is there. Logarithms are summed in whole
millionths, so the sum does not depend on its order.

Defined results: null or empty text has no words and a null score; repeated
rows get the same score (each is another document to the other); null doc_ids
are told apart by their texts only; empty tables give no rows; other columns
travel in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.hashing import WordHashes, gram_hashes, slices
from barflow.llm.shared import discard, packed, require, shuffles_deleted, staged, utf8

ORDER = 3
ALPHA = 0.4
MICRO = 1e6
# Bytes of keys that a partition gets, at most on average.
PART_BYTES = 12 << 20
# Ranges of keys that are counted one after the other; more need less disk at a time.
ROUNDS = 3
# The key of no n-gram.
NONE = np.uint64(0)


def _tokens(texts: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many each text has."""
    words = [text.lower().split() for text in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, int(sizes.sum())), sizes


def _places(sizes: np.ndarray) -> np.ndarray:
    """Place of each word in its text."""
    starts = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(starts, sizes)


def _keys(words: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Key of the n-gram that ends at each word, NONE where the text begins too late for one."""
    out = np.zeros(len(words), np.uint64)
    if len(words) >= n:
        out[n - 1 :] = gram_hashes(words, n)
    out[place < n - 1] = NONE
    return out


def _grams(words: np.ndarray, sizes: np.ndarray, order: int, low: int = 1, high: int = 1 << 64):
    """The different n-grams of a slice with keys from low to below high, sorted, and how often it has each."""
    place = _places(sizes)
    keys = np.concatenate([_keys(words, place, n) for n in range(1, order + 1)])
    return np.unique(keys[(keys >= np.uint64(low)) & (keys <= np.uint64(high - 1))], return_counts=True)


def _bounds(parts: int) -> list[int]:
    """Lowest key of each partition, and the end; a partition is a range of keys, which are hashes."""
    return [1, *[(p << 64) // parts for p in range(1, parts)], 1 << 64]


def _gaps(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps, byte by byte, so that the upper bytes are zeros and compress away."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_gaps(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view("<u8"), dtype=np.uint64)


def _small(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as a byte each; those of 255 and more apart."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()


def _from_small(small: bytes, big: bytes) -> np.ndarray:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(big, "<i8")
    return counts


SLICE = "head binary, vocabulary binary, words binary, n bigint"
PACK = "part int, slice bigint, keys binary, small binary, big binary"
FOUND = "part int, slice bigint, small binary, big binary"
SCORED = "ord bigint, mark bigint, micro bigint, n_words bigint"


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    kinds = [{"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[t] for t in types]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], list(names))


def _slices(docs: DataFrame) -> DataFrame:
    """Slices of documents: (ord, mark, words) of each, the different words, the numbers of the words among them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, 2):
            words, sizes = _tokens(batch.column(2).to_pylist(), hashes)
            head = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy(), sizes]).astype("<i8").tobytes()
            vocabulary, word = np.unique(words, return_inverse=True)
            word = word.astype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
            yield _rows([(head, vocabulary.astype("<u8").tobytes(), word.tobytes(), len(words))], SLICE)

    return docs.select("ord", "mark", "text").mapInArrow(cut, SLICE).withColumn("slice", F.monotonically_increasing_id())


def _words_of(head: bytes, vocabulary: bytes, words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ord, mark, words) of the documents of a slice, and the hashes of its words."""
    known = np.frombuffer(vocabulary, "<u8").astype(np.uint64)
    return np.frombuffer(head, "<i8").reshape(3, -1), known[np.frombuffer(words, "<u2" if len(known) <= 1 << 16 else "<u4")]


def _packs(slices_: DataFrame, order: int, bounds: list[int], first: int) -> DataFrame:
    """The n-grams that each slice has in the partitions from ``first`` on, whose bounds are given."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                facts, words = _words_of(row["head"], row["vocabulary"], row["words"])
                keys, counts = _grams(words, facts[2], order, bounds[0], bounds[-1])
                inner = np.array([b - 1 for b in bounds[1:]], np.uint64)
                edges = np.append(0, np.searchsorted(keys, inner, "right"))
                out = []
                for p in np.flatnonzero(np.diff(edges)).tolist():
                    here = slice(edges[p], edges[p + 1])
                    out.append((first + p, row["slice"], _gaps(keys[here]), *_small(counts[here])))
                yield _rows(out, PACK)

    return slices_.select("slice", "head", "vocabulary", "words").mapInArrow(pack, PACK)


def _micro(ratio: np.ndarray) -> np.ndarray:
    return np.floor(np.log(ratio) * MICRO + 0.5).astype(np.int64)


def _log_scores(
    words: np.ndarray, sizes: np.ndarray, order: int, total: int, keys: np.ndarray, counts: np.ndarray
) -> np.ndarray:
    """Summed millionths of each document of a slice, given the corpus counts of its n-grams."""
    place, doc = _places(sizes), np.repeat(np.arange(len(sizes)), sizes)
    context = counts[np.searchsorted(keys, _keys(words, place, 1))]
    score = context / total
    for n in range(2, order + 1):
        asked = _keys(words, place, n)
        there = np.flatnonzero(asked != NONE)
        number = np.searchsorted(keys, asked[there])
        known = np.ones(len(words), np.int64)
        known[there] = counts[number]
        # one that occurs once is the document's own
        often = known[there] > 1
        at, number = there[often], number[often]
        _, which, own = np.unique(doc[at] * len(keys) + number, return_inverse=True, return_counts=True)
        rest = known[at] - own[which]
        score[there] *= ALPHA
        at, rest = at[rest > 0], rest[rest > 0]
        score[at] = rest / context[at - 1]
        context = known
    summed = np.append(0, np.cumsum(_micro(score)))
    ends = np.cumsum(sizes)
    return summed[ends] - summed[ends - sizes]


def _counted(packs: DataFrame) -> DataFrame:
    """Corpus counts of the n-grams that were asked for, in their order."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        own = [_from_small(*x) for x in zip(rows["small"], rows["big"], strict=True)]
        keys = np.concatenate([_from_gaps(raw) for raw in rows["keys"]])
        _, which = np.unique(keys, return_inverse=True)
        table = np.zeros(int(which.max()) + 1, np.int64)
        np.add.at(table, which, np.concatenate(own))
        answers = np.split(table[which], np.cumsum([len(x) for x in own])[:-1])
        rows = rows.drop(columns="keys")
        rows["small"], rows["big"] = zip(*map(_small, answers), strict=True)
        return rows

    return packs.groupBy("part").applyInPandas(count, FOUND)


def _scored(slices_: DataFrame, answers: DataFrame, order: int, total: int) -> DataFrame:
    """(ord, mark, micro, n_words) of each document."""

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        (ords, marks, sizes), words = _words_of(*left.iloc[0][["head", "vocabulary", "words"]])
        right = right.sort_values("part")
        counts = [_from_small(*x) for x in zip(right["small"], right["big"], strict=True)]
        keys, _ = _grams(words, sizes, order)
        micro = _log_scores(words, sizes, order, total, keys, np.concatenate([np.empty(0, np.int64), *counts]))
        return pd.DataFrame({"ord": ords, "mark": marks, "micro": micro, "n_words": sizes})

    return slices_.groupBy("slice").cogroup(answers.groupBy("slice")).applyInPandas(score, SCORED)


def backoff_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``row`` (the other columns), n_words, log_score (millionths, summed) and score (mean logarithm per word)."""
    require(docs, "doc_id", "text")
    rows = docs.select(
        packed(docs.drop("text")).alias("row"),
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(-(1 << 63))).alias("ord"),
        utf8("text").alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    cut = staged(_slices(rows), "slices", "zstd")
    n = cut.agg(F.sum("n")).first()[0]
    if not n:
        zero, none = F.lit(0).cast("long"), F.lit(None).cast("double")
        return rows.select("row", zero.alias("n_words"), zero.alias("log_score"), none.alias("score"))
    parts = -(-n * order * 8 // PART_BYTES)
    bounds, per_round = _bounds(parts), -(-parts // ROUNDS)
    answers = []
    with shuffles_deleted(docs.sparkSession):
        for first in range(0, parts, per_round):
            packs = _packs(cut, order, bounds[first : first + per_round + 1], first)
            answers.append(staged(_counted(packs), "answers"))
        found = _scored(cut, reduce(DataFrame.union, answers), order, n)
        sums = [F.sum("micro").alias("micro"), F.sum("n_words").alias("n_words"), F.count("*").alias("copies")]
        total = staged(found.groupBy("ord", "mark").agg(*sums), "scores")
    discard(cut, *answers)
    joined = rows.select("row", "ord", "mark").join(total, ["ord", "mark"])
    return joined.select(
        "row",
        (F.col("n_words") / F.col("copies")).cast("long").alias("n_words"),
        (F.col("micro") / F.col("copies")).cast("long").alias("log_score"),
        F.when(F.col("n_words") > 0, F.col("micro") / F.lit(MICRO) / F.col("n_words")).alias("score"),
    )
