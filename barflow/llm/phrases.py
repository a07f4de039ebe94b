"""Phrase collocations by direct-address tiling of ranked ids.

Words that occur often enough get ids by frequency rank. A pair of neighbours is
a cell of a grid of ids, cut into square tiles: in each task, a tile that many
pairs of a run fall into is counted as a dense array with ``numpy.bincount``,
the cells of all other tiles as sorted coordinates. Spark sums equal cells over
all tasks, so no tile is gathered anywhere. Pairs that stay are ranked anew and
paired with the word that follows, and so on up to the longest phrase: a phrase
can only be frequent if the two phrases that it begins and ends with are. Texts
are split twice, to count words and to write their ids; each length then reads
the places that the one before left.

What tasks are sent is bounded at any size of the corpus: the HEAD most frequent
keys of each length with their ranks, and for the other frequent keys one bit
each in a table of a fixed size (a false bit costs a count, no result). Keys
beyond the head keep their 62-bit hash as id. Words of a language are told apart
by 64-bit hashes. Phrases carry their text from the counted tables, where cuts
and longer phrases are joined on it.

Scores are floor(2000000 * a / (l + r)) of the lowest-scoring cut, in decimals
of 38 digits.

Defined results: null or empty texts have no words; a null language is ``und``;
words are what spaces and tabs leave of a piece, pieces end at ``.,;:!?`` and
line ends; repeated rows count each; empty tables give no rows; other columns
are ignored, as a phrase belongs to no document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.bits import bit_table, marked
from barflow.llm.hashing import mixed, slices
from barflow.llm.shared import require, staged, utf8

LONGEST = 4
LEAST = 30
TOP = 2000
# A shorter phrase goes if a longer one around it has this share of its count (four fifths).
SHARE = (4, 5)
NO_LANGUAGE = "und"
# Keys of one length that tasks know the ranks of, and bits for the frequent keys beyond.
HEAD = 1 << 20
BITS = 1 << 27
# Ranks along a tile's side, and tiles along the grid's; ids beyond are sorted coordinates.
SIDE = 1 << 10
GRID = 1 << 10
# A tile is dense in a run where at least one cell in so many would be used.
DENSE = 32
# Pairs of a run, distinct words that a task gathers, words that a worker remembers.
RUN = 2_000_000
GATHER_WORDS = 400_000
CACHE_WORDS = 250_000
TAIL = 1 << 62

ENDS = ".,;:!?\n\x0b\x0c\r"
CLEAN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x0A if chr(b) in ENDS else 0x20 if b == 0x09 else b for b in range(256)
)
END = b"."


def words(text: bytes) -> list[bytes]:
    """Words of a text in order, with END between pieces."""
    return text.translate(CLEAN).replace(b"\n", b" . ").split()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), utf8("text").alias("text"))


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        yield lang, words(text)


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of all words, summed in each task first."""

    def flushed(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            columns = [pa.array([lang] * len(counts)), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in slices(batches, 1):
            for lang, own in _by_language(batch):
                held.setdefault(lang, Counter()).update(own)
            if sum(map(len, held.values())) > GATHER_WORDS:
                yield from flushed(held)
                held = {}
        yield from flushed(held)

    made = rows.mapInArrow(count, "lang string, word binary, n bigint").filter(F.col("word") != F.lit(END))
    return made.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_key(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=xxhash.xxh32_intdigest(lang.encode("utf-8", "replace")))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of each pair of ids."""
    return mixed(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mixed(right.astype(np.uint64) + np.uint64(1)))


@dataclass
class Ranks:
    """Ids of the frequent keys of one length: their rank in the head, else their hash; -1 for all other keys."""

    keys: np.ndarray
    ranks: np.ndarray
    bits: np.ndarray | None

    def ids(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        if len(self.keys):
            at = np.searchsorted(self.keys, keys)
            at[at == len(self.keys)] = 0
            found = self.keys[at] == keys
            out[found] = self.ranks[at[found]]
        if self.bits is not None:
            rest = np.flatnonzero(out < 0)
            rest = rest[marked(self.bits, keys[rest])]
            out[rest] = tail_ids(keys[rest])
        return out


def tail_ids(keys: np.ndarray) -> np.ndarray:
    return ((keys & np.uint64(TAIL - 1)) | np.uint64(TAIL)).astype(np.int64)


def ranked(table: DataFrame, head: int, bits: int) -> Ranks:
    """Ranks of a written table (key, n) of frequent keys; at most ``head`` of them come to the driver."""
    bucket = F.floor(F.log2("n") * 16).cast("int")
    sizes = table.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("bucket")).collect()
    total, least = 0, None
    for r in sizes:
        total += r.k
        if total > head:
            break
        least = r.bucket
    whole = total <= head
    picked = table.select("key", "n") if whole else table.filter(bucket >= least) if least is not None else table.limit(0)
    rows = picked.select("key", "n").toArrow()
    keys = rows.column("key").to_numpy().view(np.uint64)
    by_count = np.lexsort((keys, -rows.column("n").to_numpy()))
    ranks = np.empty(len(keys), np.int64)
    ranks[by_count] = np.arange(len(keys))
    order = np.argsort(keys)
    return Ranks(keys[order], ranks[order], None if whole else bit_table(table.select("key"), bits))


class _Ids(dict):
    """Id of each word of a language, remembered."""

    def __init__(self, lang: str, ranks: Ranks) -> None:
        super().__init__()
        self.lang, self.ranks = lang, ranks

    def __missing__(self, word: bytes) -> int:
        value = -1 if word == END else int(self.ranks.ids(np.array([word_key(self.lang, word)], np.uint64))[0])
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


def _stream(batch: pa.RecordBatch, held: dict[str, _Ids], ranks: Ranks) -> np.ndarray:
    """Word ids of a batch, -1 at infrequent words and where a piece or a text ends."""
    parts, end = [], np.array([-1], np.int64)
    for lang, own in _by_language(batch):
        if lang not in held:
            if len(held) >= 64:
                held.clear()
            held[lang] = _Ids(lang, ranks)
        parts += [np.fromiter(map(held[lang].__getitem__, own), np.int64, len(own)), end]
    return np.concatenate(parts) if parts else end


def _spelled(ids: np.ndarray) -> bytes:
    """Ids as bytes, four each where they fit; the first byte tells."""
    small = not len(ids) or ids.max() < 1 << 31
    return b"4" + ids.astype("<i4").tobytes() if small else b"8" + ids.astype("<i8").tobytes()


def _read(held: bytes) -> np.ndarray:
    return np.frombuffer(held, f"<i{held[:1].decode()}", offset=1).astype(np.int64)


def _places(left: bytes, right: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) of consecutive places: a phrase and the word behind it; left is -1 where places break off."""
    if right is not None:
        return _read(left), _read(right)
    ids = _read(left)
    return np.where(ids[1:] < 0, -1, ids[:-1]), ids[1:]


def _word_places(rows: DataFrame, ranks: Ranks) -> DataFrame:
    """Places of batches of texts, of which only the word ids are kept: each is also the one behind the last."""
    sent = rows.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Ids] = {}
        for batch in slices(batches, 1):
            left = pa.array([_spelled(_stream(batch, held, sent.value))], pa.binary())
            yield pa.RecordBatch.from_arrays([left, pa.nulls(1, pa.binary())], ["left", "right"])

    return rows.mapInArrow(run, "left binary, right binary")


def _longer_places(places: DataFrame, ranks: Ranks) -> DataFrame:
    """Places of phrases one word longer, where this one and the next are frequent."""
    sent = places.sparkSession.sparkContext.broadcast(ranks)

    def longer(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, held = np.full(len(left), -1, np.int64), np.flatnonzero(left >= 0)
        ids[held] = sent.value.ids(pair_keys(left[held], right[held]))
        both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        ends = np.flatnonzero(np.diff(both) != 1) + 1
        return np.insert(ids[both], ends, -1), np.insert(right[both + 1], ends, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            found = [longer(*_places(*p)) for p in pairs]
            columns = [pa.array([_spelled(f[i]) for f in found], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["left", "right"])

    return places.mapInArrow(run, "left binary, right binary")


def tiled_counts(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and their numbers: dense tiles by bincount, the rest as sorted coordinates."""
    out = []
    near = (left < SIDE * GRID) & (right < SIDE * GRID)
    a, b = left[near], right[near]
    tile = a // SIDE * GRID + b // SIDE
    order = np.argsort(tile, kind="stable")
    a, b, tile = a[order], b[order], tile[order]
    edges = np.append(np.flatnonzero(np.append(True, tile[1:] != tile[:-1])), len(tile)) if len(tile) else np.zeros(1, np.int64)
    sparse = np.ones(len(tile), bool)
    for low in np.flatnonzero(np.diff(edges) >= SIDE * SIDE // DENSE).tolist():
        here = slice(edges[low], edges[low + 1])
        sparse[here] = False
        first_a, first_b = tile[here.start] // GRID * SIDE, tile[here.start] % GRID * SIDE
        cells = np.bincount((a[here] - first_a) * SIDE + b[here] - first_b, minlength=SIDE * SIDE)
        used = np.flatnonzero(cells)
        out.append((used // SIDE + first_a, used % SIDE + first_b, cells[used]))
    key, counts = np.unique(a[sparse] * (SIDE * GRID) + b[sparse], return_counts=True)
    out.append((key // (SIDE * GRID), key % (SIDE * GRID), counts))
    far_a, far_b = left[~near], right[~near]
    order = np.lexsort((far_b, far_a))
    far_a, far_b = far_a[order], far_b[order]
    first = np.flatnonzero(np.append(True, (far_a[1:] != far_a[:-1]) | (far_b[1:] != far_b[:-1]))) if len(far_a) else np.zeros(0, np.int64)
    out.append((far_a[first], far_b[first], np.diff(np.append(first, len(far_a)))))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def _pair_counts(places: DataFrame) -> DataFrame:
    """(left, right, n) of all places."""

    def flushed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        left, right = (np.concatenate([h[i] for h in held]) if held else np.empty(0, np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in tiled_counts(left, right)], ["left", "right", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                left, right = _places(*pair)
                held.append((left[left >= 0], right[left >= 0]))
                size += len(held[-1][0])
                if size > RUN:
                    yield flushed(held)
                    held, size = [], 0
        yield flushed(held)

    made = places.mapInArrow(count, "left bigint, right bigint, n bigint")
    return made.groupBy("left", "right").agg(F.sum("n").alias("n"))


def _keyed(pairs: DataFrame) -> DataFrame:
    """The columns and ``key``, the hash of the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pair_keys(batch.column(0).to_numpy(), batch.column(1).to_numpy()).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], ["left", "right", "n", "key"])

    return pairs.mapInArrow(run, "left bigint, right bigint, n bigint, key bigint")


def _word_keyed(counts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            key = np.array([word_key(lang, word) for lang, word in pairs], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], ["lang", "word", "n", "key"])

    return counts.mapInArrow(run, "lang string, word binary, n bigint, key bigint")


def _with_ids(table: DataFrame, ranks: Ranks) -> DataFrame:
    """The columns and ``id``, by which longer phrases name the key."""
    sent = table.sparkSession.sparkContext.broadcast(ranks)
    at = table.columns.index("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = sent.value.ids(batch.column(at).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids)], [*batch.schema.names, "id"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields)
    return table.mapInArrow(run, f"{kinds}, id bigint")


def counted_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, head: int = HEAD, bits: int = BITS):
    """(totals, phrases): n of each lang, and lang, k, phrase (its words) and a of all phrases that occur often enough."""
    require(docs, "lang", "text")
    if longest < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur at least once")
    rows = _rows(docs)
    counts = staged(_word_counts(rows), "words", "zstd")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    table = staged(_word_keyed(counts.filter(F.col("n") >= least)), "frequent")
    ranks = ranked(table, head, bits)
    places = staged(_word_places(rows, ranks), "places-1", "zstd")
    single = staged(_with_ids(table, ranks).select("id", "lang", F.col("word").cast("string").alias("word"), "n"), "named")
    of_word = single.select(F.col("id").alias("right"), "word")
    known = single.select("id", "lang", F.array("word").alias("phrase"), "n")
    found = [known]
    for k in range(2, longest + 1):
        table = staged(_keyed(_pair_counts(places).filter(F.col("n") >= least)), f"pairs-{k}", "zstd")
        ranks = ranked(table, head, bits)
        longer = _with_ids(table, ranks).select("id", "left", "right", "n")
        begun = known.select(F.col("id").alias("left"), "lang", "phrase")
        longer = longer.join(begun, "left").join(of_word, "right")
        known = staged(longer.select("id", "lang", F.concat("phrase", F.array("word")).alias("phrase"), "n"), f"known-{k}")
        found.append(known)
        if k < longest:
            places = staged(_longer_places(places, ranks), f"places-{k}", "zstd")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return totals, out.select("lang", F.size("phrase").alias("k"), "phrase", F.col("n").alias("a"))


def _scored(phrases: DataFrame) -> DataFrame:
    """The phrases of two words and more with l, r and score of their lowest-scoring cut."""
    counts = phrases.select("lang", F.concat_ws(" ", "phrase").alias("part"), F.col("a").alias("f"))
    many = phrases.filter("k > 1")
    cuts = many.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumn("first", F.concat_ws(" ", F.slice("phrase", F.lit(1), F.col("cut"))))
    cuts = cuts.withColumn("rest", F.concat_ws(" ", F.slice("phrase", F.col("cut") + 1, F.col("k") - F.col("cut"))))
    cuts = cuts.join(counts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("cast(2000000 * cast(a as decimal(28, 0)) as decimal(38, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    cuts = cuts.withColumn("score", score)
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("m")
    out = cuts.groupBy("lang", "phrase", "k", "a").agg(lowest)
    return out.select("lang", "phrase", "k", "a", "m.l", "m.r", "m.score")


def _around(phrases: DataFrame) -> DataFrame:
    """(lang, part, f): the count of the most frequent longer phrase around each phrase of two words and more."""
    longer = phrases.filter("k > 2")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: F.concat_ws(" ", F.slice("phrase", i, n))),
        )
    )
    parts = longer.select("lang", F.col("a").alias("f"), F.explode(F.array_distinct(spans)).alias("part"))
    return parts.groupBy("lang", "part").agg(F.max("f").alias("f"))


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, head: int = HEAD, bits: int = BITS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    totals, phrases = counted_phrases(docs, longest, least, head, bits)
    scored = _scored(phrases).withColumn("part", F.concat_ws(" ", "phrase"))
    judged = scored.join(_around(phrases), ["lang", "part"], "left")
    more, of = SHARE
    kept = judged.filter(f"f is null or cast({of} as decimal(10, 0)) * cast(f as decimal(20, 0)) < cast({more} as decimal(10, 0)) * cast(a as decimal(20, 0))")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "part")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    out = best.join(totals, "lang")
    longs = [F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    return out.select("lang", F.col("rank").cast("long").alias("rank"), F.col("part").alias("phrase"), *longs)
