"""SimHash near-dedup with a forest of vantage-point trees.

Fingerprints link at ``radius`` or fewer differing bits. Distances of unrelated
texts lie close to half the bits, and a ball of the whole radius overlaps
nearly every branch of a tree over all bits. So the bits are cut into segments,
each with its own tree over the Hamming distance on its bits: of two
fingerprints within the radius some segment differs in at most ``radius //
segments`` bits, and there the triangle bound prunes well. A node of a tree
holds a vantage point v and a median m; a fingerprint at distance d from v
belongs to the inner branch if d <= m and may have neighbours within r in both
only if m - r < d <= m + r.

Trees are fitted on a bounded sample of fingerprints (it shapes the shards, not
the result); every distinct fingerprint is sent to its home shard and, as a
query, to the shards before it whose region its ball overlaps, so each close
pair meets in a shard at least once. A shard whose sides exceed
``BLOCK`` is dealt out as pairs of blocks. Within a unit all pairs are compared
in numpy and only spanning links are returned, at most one per fingerprint, so
a group of copies of any size yields no list of pairs. Equal fingerprints are
one row from the start. Components come from joins on written tables.

Defined results: null text and text without words have fingerprint zero and are
linked like any other; a null doc_id is passed over in choosing the smallest;
repeated rows fall into one component; an empty table gives no rows; other
columns travel in ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.components import components
from barflow.llm.hashing import gathered
from barflow.llm.shared import packed, require, staged, utf8

@dataclass(frozen=True)
class Measure:
    """Words per shingle, 64-bit words per fingerprint, and the most differing bits of a link."""

    shingle: int = 4
    words: int = 1
    radius: int = 4
    segments: int = 3

    @property
    def reach(self) -> int:
        """Differing bits that some segment of linked fingerprints has at most; asking so far makes the search exact."""
        return self.radius // self.segments

    def cuts(self) -> list[tuple[int, int, int]]:
        """(word, shift, width) of each segment; no segment spans two words."""
        per = -(-self.segments // self.words)
        sizes = [64 // per + (i >= per - 64 % per) for i in range(per)]
        return [(w, sum(sizes[:i]), sizes[i]) for w in range(self.words) for i in range(per)]


CLOSE = Measure()
# 256 bits: of texts whose shingle sets have a Jaccard similarity of 0.8 (cosine
# 8/9) 15.2 % of the bits differ, 39 on average with a deviation of 6. A radius is
# no exact limit of the similarity, so the pipeline uses ``near_sets`` instead.
# The search is exact, but a ball reaches most branches of every tree.
SIMILAR = Measure(shingle=5, words=4, radius=42, segments=20)
SEED = 42
# Fingerprints that fit the trees; fingerprints of a shard on average; a shard's block.
SAMPLE = 1 << 14
LEAF = 4096
MOST_DEPTH = 12
BLOCK = 8192
ROWS = 1 << 15
# Fingerprints that are routed through the trees at once.
ROUTED = 1 << 16


def fingerprint(text: bytes, measure: Measure = CLOSE) -> list[int]:
    """SimHash over word shingles: a bit is set where over half of their hashes have it set."""
    words, n = text.lower().split(), measure.shingle
    if not words:
        return [0] * measure.words
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    spans = zip(starts[: max(1, len(words) - n + 1)].tolist(), ends[min(n, len(words)) - 1 :].tolist(), strict=True)
    shingles, out = [line[a:b] for a, b in spans], []
    for word in range(measure.words):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED + word)), "<u8", len(shingles))
        counts = np.zeros(64, np.int64)
        for i in range(0, len(hashes), ROWS):
            bits = np.unpackbits(hashes[i : i + ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        on = np.packbits(2 * counts > len(hashes), bitorder="little")
        out.append(int(on.view("<u8")[0]))
    return out


def _columns(measure: Measure) -> list[str]:
    return [f"fp{w}" for w in range(measure.words)]


def _marks(batch: pa.RecordBatch, measure: Measure) -> np.ndarray:
    """Fingerprints of a batch, a row of unsigned words each."""
    return np.stack([batch.column(c).to_numpy().view(np.uint64) for c in _columns(measure)], axis=1)


def fingerprints(docs: DataFrame, measure: Measure = CLOSE, whole_rows: bool = False) -> DataFrame:
    """``row``, doc_id and the words of the fingerprint, fp0 first, as signed numbers."""
    require(docs, "doc_id", "text")
    names = _columns(measure)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            marks = np.array([fingerprint(t, measure) for t in texts], np.uint64).reshape(-1, measure.words)
            words = [pa.array(marks[:, w].copy().view(np.int64)) for w in range(measure.words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *words], ["row", "doc_id", *names])

    row = packed(docs if whole_rows else docs.drop("text"))
    rows = docs.select(row.alias("row"), docs["doc_id"].alias("doc_id"), utf8("text").alias("text"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("row", "doc_id")]
    words = ", ".join(f"{c} bigint" for c in names)
    return rows.mapInArrow(run, f"row {kinds[0]}, doc_id {kinds[1]}, {words}")


def _segment(marks: np.ndarray, cut: tuple[int, int, int]) -> np.ndarray:
    word, shift, width = cut
    return (marks[:, word] >> np.uint64(shift)) & np.uint64((1 << width) - 1)


def fit_trees(sample: np.ndarray, measure: Measure, depth: int, seed: int = SEED) -> list[dict[int, tuple[int, int]]]:
    """Per segment a tree: node number -> (vantage point, median); children of i are 2i + 1 and 2i + 2."""
    rng = np.random.default_rng(seed)
    trees = []
    for cut in measure.cuts():
        nodes: dict[int, tuple[int, int]] = {}
        parts = {0: _segment(sample, cut)}
        for node in range((1 << depth) - 1):
            own = parts.pop(node, np.empty(0, np.uint64))
            if len(own) < 2:
                continue
            best = None
            for v in rng.choice(own, min(8, len(own)), replace=False):
                d = np.bitwise_count(own ^ v)
                m = int(np.median(d))
                if not (d > m).any():
                    m -= 1
                inner = int((d <= m).sum())
                # even halves, and few on the boundary
                cost = abs(2 * inner - len(own)) + int(((d > m - 1) & (d <= m + 1)).sum())
                if inner and (best is None or cost < best[0]):
                    best = (cost, v, m, d)
            if best is None:
                continue
            _, v, m, d = best
            nodes[node] = (int(v), m)
            parts[2 * node + 1], parts[2 * node + 2] = own[d <= m], own[d > m]
        trees.append(nodes)
    return trees


def route(own: np.ndarray, nodes: dict[int, tuple[int, int]], radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indexes, home): where each fingerprint lives and which leaves before its own it must ask.

    A branch is pruned when the triangle inequality rules out a neighbour in it.
    """
    home_leaf = np.zeros(len(own), np.int64)
    leaves: list[tuple[int, np.ndarray, np.ndarray]] = []
    stack = [(0, np.arange(len(own)), np.ones(len(own), bool))]
    while stack:
        node, at, home = stack.pop()
        if node not in nodes:
            home_leaf[at[home]] = node
            leaves.append((node, at, home))
            continue
        v, m = nodes[node]
        d = np.bitwise_count(own[at] ^ np.uint64(v)).astype(np.int64)
        inner = d <= m
        for child, reach, lives in ((2 * node + 1, d <= m + radius, inner), (2 * node + 2, d > m - radius, ~inner)):
            if reach.any():
                stack.append((child, at[reach], (home & lives)[reach]))
    for leaf, at, home in leaves:
        asks = home | (leaf < home_leaf[at])
        if asks.any():
            yield leaf, at[asks], home[asks]


def spanning_links(base: np.ndarray, probe: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(probe, base) indexes that connect all that pairs within ``radius`` connect; fewer than both together."""
    label = np.arange(len(base) + len(probe))
    links = []
    step = max(1, (1 << 21) // max(1, len(base)))
    for i in range(0, len(probe), step):
        apart = np.zeros((len(probe[i : i + step]), len(base)), np.uint16)
        for w in range(base.shape[1]):
            apart += np.bitwise_count(probe[i : i + step, w, None] ^ base[None, :, w])
        close = apart <= radius
        for row in np.flatnonzero(close.any(axis=1)).tolist():
            near = np.flatnonzero(close[row])
            groups, at = np.unique(label[near], return_index=True)
            own = label[len(base) + i + row]
            joined = groups != own
            if joined.any():
                links += [(i + row, int(near[j])) for j in at[joined].tolist()]
                label[np.isin(label, groups[joined])] = own
    return links


def near_links(nodes: DataFrame, measure: Measure = CLOSE) -> DataFrame:
    """Spanning links (a, b) between the ids of the distinct fingerprints of a written table."""
    spark, names, cuts = nodes.sparkSession, _columns(measure), measure.cuts()
    sample = nodes.select(*names).orderBy(F.xxhash64(*names), *names).limit(SAMPLE).toArrow()
    sample = np.stack([sample.column(c).to_numpy().view(np.uint64) for c in names], axis=1)
    depth = min(MOST_DEPTH, max(0, math.ceil(math.log2(max(nodes.count(), 1) / LEAF))))
    trees = spark.sparkContext.broadcast(fit_trees(sample, measure, depth))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # every node of the trees is visited for each batch, so batches should be long
        for batch in gathered(batches, ROUTED):
            marks = _marks(batch, measure)
            for tree, (cut, nodes) in enumerate(zip(cuts, trees.value, strict=True)):
                parts = list(route(_segment(marks, cut), nodes, measure.reach))
                if parts:
                    sizes = [len(at) for _, at, _ in parts]
                    picked = batch.take(pa.array(np.concatenate([at for _, at, _ in parts])))
                    routed = [
                        pa.array(np.full(sum(sizes), tree, np.int32)),
                        pa.array(np.repeat([leaf for leaf, _, _ in parts], sizes).astype(np.int32)),
                        pa.array(np.concatenate([home for _, _, home in parts])),
                    ]
                    yield pa.RecordBatch.from_arrays([*routed, *picked.columns], ["tree", "leaf", "home", "id", *names])

    words = ", ".join(f"{c} bigint" for c in names)
    routed = nodes.select("id", *names).mapInArrow(deal, f"tree int, leaf int, home boolean, id bigint, {words}")
    dealt = staged(routed, "dealt")
    key = ["tree", "leaf"]
    sizes = dealt.groupBy(*key).agg(F.sum(F.col("home").cast("long")).alias("held"), F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.greatest("held", F.col("n") - F.col("held")) / BLOCK).cast("int")
    large = staged(sizes.select(*key, blocks.alias("k")).filter("k > 1"), "large")
    keyed = dealt.join(large, key, "left")
    whole = keyed.filter("k IS NULL").select(*key, F.lit(0).alias("i"), F.lit(0).alias("j"), "home", "id", *names)
    # In a large shard a member of block x is the base of units (x, j) and
    # probes units (i, x) before its own; a query of block x probes all (i, x).
    keyed = keyed.filter("k > 1").withColumn("x", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    steps = F.sequence(F.lit(0), F.col("k") - 1)
    probe = F.lit(False).alias("home")
    as_base = keyed.filter("home").select(*key, F.col("x").alias("i"), F.explode(steps).alias("j"), "home", "id", *names)
    as_probe = keyed.select(*key, F.explode(steps).alias("i"), F.col("x").alias("j"), "home", "id", *names)
    as_probe = as_probe.filter("NOT home OR i < j").select(*key, "i", "j", probe, "id", *names)

    def link(unit: pd.DataFrame) -> pd.DataFrame:
        marks = np.stack([unit[c].to_numpy().view(np.uint64) for c in names], axis=1)
        ids, held = unit["id"].to_numpy(), unit["home"].to_numpy()
        links = []
        if (~held).any():
            own, other = ids[~held], ids[held]
            links += [(own[p], other[b]) for p, b in spanning_links(marks[held], marks[~held], measure.radius)]
        if unit["i"].iloc[0] == unit["j"].iloc[0]:
            # the block within itself: each row against those before it is enough
            own, other = ids[held], ids[held]
            links += [(own[p], other[b]) for p, b in inner_links(marks[held], measure.radius)]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    units = whole.unionByName(as_base).unionByName(as_probe).groupBy(*key, "i", "j")
    return units.applyInPandas(link, "a bigint, b bigint")


def inner_links(marks: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """The same for the pairs within one set."""
    label, links = np.arange(len(marks)), []
    step = max(1, (1 << 21) // max(1, len(marks)))
    for i in range(0, len(marks), step):
        rows = marks[i : i + step]
        apart = np.zeros((len(rows), i + len(rows)), np.uint16)
        for w in range(marks.shape[1]):
            apart += np.bitwise_count(rows[:, w, None] ^ marks[None, : i + len(rows), w])
        close = apart <= radius
        # a row is close to itself
        for row in np.flatnonzero(close.sum(axis=1) > 1).tolist():
            near = np.flatnonzero(close[row])
            groups, at = np.unique(label[near], return_index=True)
            own = label[i + row]
            joined = groups != own
            if joined.any():
                links += [(i + row, int(near[j])) for j in at[joined].tolist()]
                label[np.isin(label, groups[joined])] = own
    return links


def near_components(marked: DataFrame, measure: Measure = CLOSE) -> DataFrame:
    """``root`` (of the component) and component_id (the smallest doc_id reachable) for each row of a written table."""
    names = _columns(measure)
    nodes = marked.groupBy(*names).agg(F.min("doc_id").alias("least")).withColumn("id", F.monotonically_increasing_id())
    nodes = staged(nodes, "fingerprints")
    roots = components(near_links(nodes, measure)).withColumnRenamed("node", "id")
    named = staged(nodes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_mark = named.join(least, "root", "left")
    of_mark = of_mark.select(*names, "root", "component_id")
    return marked.join(staged(of_mark, "components"), names, "left")


def near_duplicates(docs: DataFrame, measure: Measure = CLOSE) -> DataFrame:
    """``row``, doc_id, the fingerprint's words and component_id of every document."""
    return near_components(staged(fingerprints(docs, measure), "marked"), measure)


def one_of_each(docs: DataFrame, measure: Measure = SIMILAR) -> DataFrame:
    """The documents with one of each component: that of the smallest doc_id, once."""
    marked = fingerprints(docs, measure, whole_rows=True).withColumn("rid", F.monotonically_increasing_id())
    marked = staged(marked, "marked")
    judged = near_components(marked.drop("row"), measure)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    kept = judged.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.rid").alias("rid"))
    # what stays grows with the documents, so it is never broadcast
    out = marked.join(kept.hint("merge"), "rid", "left_semi")
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
