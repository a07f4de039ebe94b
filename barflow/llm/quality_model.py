"""Quality classifier: learned vectors of words and their character n-grams, averaged per document.

Every word of a document and every n-gram of it (three to five characters, with
marks at both ends) has a hashed number and a learned vector, and so has the pair
of a word with itself. A document is the mean of the vectors of all its words,
n-grams and such pairs, as often as they occur, and a linear layer with softmax
turns it into the probability of each label. Vectors and layer are trained
together by stochastic gradient descent in numpy.

The model is fitted on a bounded sample: at most SAMPLE_ROWS labelled documents
(those of the smallest hashes of their ids) and SAMPLE_BYTES of their features,
whatever the corpus. The sample's features are computed in the tasks from whole
texts; only these numbers come to the driver. Scoring reads every whole text:
since averaging and the layer are linear, each number has one weight after
training.

Defined results: null and empty texts, and texts without words, are scored by
the layer's constant; rows of one doc_id count once in the sample (that of the
smallest text hash); null doc_ids and null labels are never learned from; an id
with both labels is not learned from either; without usable labels every score
is 0.5; repeated rows are scored each; empty tables give no rows. Other columns
travel in ``row``.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.hashing import slices
from barflow.llm.shared import packed, require, utf8

WORD_BITS = 16
GRAM_BITS = 17
# Number of a word that repeats the one before, whichever it is; the last one.
REPEAT = (1 << WORD_BITS) + (1 << GRAM_BITS)
GRAMS = (3, 4, 5)
WIDTH = 16
EPOCHS = 5
RATE = 0.2
SEED = 11
# Bound of the sample that the model is fitted on.
SAMPLE_ROWS = 4096
SAMPLE_BYTES = 96 << 20
# Words whose characters are hashed at once.
PIECE_WORDS = 1 << 15
# Odd multipliers that spread the bits of 32-bit hashes.
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
LIMIT = 0.3


def numbers(text: str) -> np.ndarray:
    """Numbers of the words, n-grams and repeats of a whole text, each as often as it occurs."""
    words = text.split()
    repeats = sum(map(operator.eq, words, words[1:]))
    found = [np.full(repeats, REPEAT, np.int32)]
    for start in range(0, len(words), PIECE_WORDS):
        found += _numbers(words[start : start + PIECE_WORDS])
    return np.concatenate(found)


def _numbers(words: list[str]) -> list[np.ndarray]:
    """Hashes of all words and n-grams at once: windows over the marked characters that stay inside one word."""
    chars = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "replace"), np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(length) - length
    place = np.arange(len(chars)) - np.repeat(first, length)
    left = np.repeat(length, length) - place
    spread = _mixed(chars * FACTORS[0] + place.astype(np.uint32) * FACTORS[1])
    out = [(_mixed(np.add.reduceat(spread, first, dtype=np.uint32)) >> np.uint32(32 - WORD_BITS)).astype(np.int32)]
    for n in GRAMS:
        if len(chars) < n:
            continue
        end = len(chars) - n + 1
        gram = np.full(end, n, np.uint32)
        for i in range(n):
            gram *= FACTORS[0]
            gram += chars[i : i + end]
        gram = _mixed(gram[left[:end] >= n]) >> np.uint32(32 - GRAM_BITS)
        out.append(gram.astype(np.int32) + (1 << WORD_BITS))
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * FACTORS[2]
    h = (h ^ (h >> np.uint32(13))) * FACTORS[3]
    return h ^ (h >> np.uint32(16))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of a whole text and how often each occurs."""
    total = np.bincount(numbers(text), minlength=1)
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.int32)


def _texts(column: pa.Array) -> Iterator[str]:
    return (t.decode("utf-8", "replace") for t in column.to_pylist())


@dataclass
class Model:
    """Weight of each number in the difference of the two labels' outputs, and the constant."""

    weights: np.ndarray
    constant: float

    def probability(self, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Probability of label 1 from summed weights and numbers of features."""
        mean = np.divide(total, count, out=np.zeros(len(total)), where=count > 0)
        return 1 / (1 + np.exp(-np.clip(mean + self.constant, -500, 500)))


def trained(sample: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> Model:
    """Fit vectors and layer on (numbers, counts, label) by gradient descent, one document a step."""
    if not sample:
        return Model(np.zeros(REPEAT + 1), 0.0)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (REPEAT + 1, WIDTH)).astype(np.float32)
    layer, constant = np.zeros((2, WIDTH), np.float32), np.zeros(2, np.float32)
    shares = [(counts / counts.sum()).astype(np.float32) if len(counts) else counts.astype(np.float32) for _, counts, _ in sample]
    steps, done = epochs * len(sample), 0
    for _ in range(epochs):
        for i in rng.permutation(len(sample)).tolist():
            at, _, label = sample[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            hidden = shares[i] @ vectors[at]
            out = layer @ hidden + constant
            out = np.exp(out - out.max())
            slope = out / out.sum()
            slope[label] -= 1
            back = layer.T @ slope
            layer -= rate * np.outer(slope, hidden)
            constant -= rate * slope
            # as in the mean of n vectors, each takes the whole slope in proportion to its share
            vectors[at] -= np.outer(shares[i] * (rate * len(at)), back)
    apart = (layer[1] - layer[0]).astype(np.float64)
    return Model(vectors.astype(np.float64) @ apart, float(constant[1] - constant[0]))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept out of learning; a null id is not, but it has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES):
    """(numbers, counts, label) of a bounded set of labelled documents that are not held out."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", label)
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other")).filter("label = other")
    picked = known.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` rows, so sending them out is bounded
    of_sample = docs.select("doc_id", utf8("text").alias("text")).join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [features(t) for t in _texts(batch.column(1))]
            held = [pa.array([f[i].tobytes() for f in found], pa.binary()) for i in (0, 1)]
            mark = pa.array([xxhash.xxh64_intdigest(f[0].tobytes() + f[1].tobytes()) >> 1 for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), mark, *held], ["doc_id", "label", "mark", "numbers", "counts"])

    ids = docs.schema["doc_id"].dataType.simpleString()
    kind = known.schema["label"].dataType.simpleString()
    made = of_sample.select("doc_id", "text", "label").mapInArrow(
        run, f"doc_id {ids}, label {kind}, mark bigint, numbers binary, counts binary"
    )
    one = made.groupBy("doc_id").agg(F.min(F.struct("mark", "label", "numbers", "counts")).alias("m"))
    ordered = one.select(F.xxhash64("doc_id").alias("order"), "doc_id", "m.label", "m.numbers", "m.counts").orderBy("order", "doc_id")
    sample, held = [], 0
    for r in ordered.toLocalIterator():
        held += len(r.numbers) + len(r.counts)
        if held > size:
            break
        sample.append((np.frombuffer(r.numbers, np.int32), np.frombuffer(r.counts, np.int32), int(r.label)))
    return sample


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the other columns) and score: the probability of label 1, from each whole text."""
    require(docs, "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(packed(docs.drop("text")).alias("row"), utf8("text").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches, 1):
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for i, text in enumerate(_texts(batch.column(1))):
                own = numbers(text)
                total[i], count[i] = model.weights[own].sum(), len(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(total, count))], ["row", "score"])

    return rows.mapInArrow(run, f"row {kind}, score double")


def classified(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: float = LIMIT) -> DataFrame:
    """``row`` (the other columns), held_out, score and predicted of every document."""
    out = scored(docs, trained(sample_of(docs, labels, label)))
    return out.select(
        "row", held_out(F.col("row.doc_id")).alias("held_out"), "score", F.when(F.col("score") >= limit, 1).otherwise(0).alias("predicted")
    )
