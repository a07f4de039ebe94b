"""Quality classifier, phrases and vector codes against plain versions and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_tables import CLASHES, SMALL, awkward, by_repr, docs_of, pairs
from pyspark.sql import types as T

from barflow.llm import phrases, quality_model, registry, vector_codes

registry.load()
MIDDLE = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- vector codes


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """{(vec_id, row number): (code, error)} and the text of the codebooks, in Python's integers."""
    kept = [(i, v, [math.floor(1024 * x) for x in e]) for i, (v, e) in enumerate(rows) if e and all(x is not None and math.isfinite(x) for x in e)]
    if not kept:
        return {}, ""
    kept.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[own[p] for own in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for own in cut:
                held[nearest(own[p], books[p])[1]].append(own[p])
            for k, group in held.items():
                books[p][k] = [sum(c) // len(group) for c in zip(*group, strict=True)]
    out = {}
    for (i, vec_id, _), own in zip(kept, cut, strict=True):
        found = [nearest(own[p], books[p]) for p in range(parts)]
        out[vec_id, i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found))
    return out, ",".join(str(x) for book in books for e in book for x in e)


def vectors_of(spark, rows):
    fields = [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]
    fields += [T.StructField(name, T.StringType()) for name in [*CLASHES, "code", "error", "vector", "part", "entry", "n", "id"] if name != "label"]
    return spark.createDataFrame([(v, e, None, *["x"] * (len(fields) - 3)) for v, e in rows], T.StructType(fields))


def coded_rows(spark, rows, **kw):
    df = vectors_of(spark, rows)
    books = vector_codes.learned_codebooks(df, **kw)
    out = vector_codes.coded(df, books).select("row.vec_id", "code", "error").collect()
    return sorted(((r.vec_id, r.code.hex(), r.error) for r in out), key=repr), books


def random_vectors(seed, n, width, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (7, width))
    return [(int(i), [float(np.float32(x)) for x in centres[i % 7] + rng.normal(0, 0.2, width)]) for i in range(n)]


@pytest.mark.parametrize("entries", [1, 5, 256])
def test_codes_equal_a_plain_version(spark, entries):
    rows = random_vectors(1, 90, 8) + [(7, None), (200, []), (201, [None] * 8), (202, [float("nan")] * 8), (203, [1.0] * 7 + [float("inf")])]
    rows += [(3, rows[3][1])] * 30 + [(None, rows[5][1]), (204, [-0.5] * 8), (205, [0.0] * 8), (206, [0.0] * 8)]
    got, books = coded_rows(spark, rows, entries=entries)
    plain, text = plain_codes(rows, entries=entries)
    assert books.text() == text
    assert got == sorted(((v, *c) for (v, _), c in plain.items()), key=repr)


def test_codes_of_large_components(spark):
    """Beyond the exact range of doubles the search goes on in whole numbers; beyond 64 bits it is refused."""
    rows = [(v, [float(np.float32(1000 * x)) for x in e[:7]] + [100_000.5 - v]) for v, e in random_vectors(2, 40, 8, 9.0)]
    got, books = coded_rows(spark, rows, entries=6)
    plain, text = plain_codes(rows, entries=6)
    assert books.text() == text and got == sorted(((v, *c) for (v, _), c in plain.items()), key=repr)
    with pytest.raises(Exception, match="cannot be coded"):
        coded_rows(spark, [*rows, (99, [200_000.0] * 8)], entries=6)


def test_no_vectors(spark):
    assert coded_rows(spark, [(1, None), (2, [])]) == ([], None)
    assert vector_codes.coded(vectors_of(spark, []), None).collect() == []


def test_unlike_lengths_are_refused(spark):
    with pytest.raises(Exception, match="unlike lengths"):
        coded_rows(spark, [(1, [1.0] * 8), (2, [1.0] * 4)])
    with pytest.raises(ValueError, match="cannot be cut"):
        coded_rows(spark, [(1, [1.0] * 6)])


def test_search_finds_the_nearest_with_ties_to_the_lower_number():
    rng = np.random.default_rng(5)
    for width, high in ((1, 4), (2, 6), (5, 900), (16, 5)):
        entries = rng.integers(-high, high, (40, width))
        parts = rng.integers(-2 * high, 2 * high, (500, width))
        best, apart = vector_codes.Codebook(entries).nearest(parts)
        every = ((parts[:, None] - entries) ** 2).sum(axis=2)
        assert (apart == every.min(axis=1)).all() and (best == every.argmin(axis=1)).all()


def test_search_leaves_far_entries_alone(monkeypatch):
    """Where entries form clusters, the walk ends long before the whole list was looked at."""
    rng = np.random.default_rng(6)
    entries = (rng.integers(-100_000, 100_000, (16, 1, 8)) + rng.integers(-50, 50, (16, 16, 8))).reshape(-1, 8)
    parts = entries[rng.integers(0, 256, 2000)] + rng.integers(-5, 5, (2000, 8))
    book = vector_codes.Codebook(entries)
    looked = []
    all_of = np.ix_
    monkeypatch.setattr(vector_codes.np, "ix_", lambda a, b: looked.append(len(a) * len(b)) or all_of(a, b))
    best, _ = book.nearest(parts)
    every = ((parts[:, None] - entries) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all()
    # each look is seen twice: at the marks and at the marking
    assert sum(looked) / 2 < 0.5 * every.size


def test_decoded_vectors_have_the_stated_error(spark):
    rows = random_vectors(3, 60, 8)
    df = vectors_of(spark, rows)
    books = vector_codes.learned_codebooks(df, entries=16)
    out = vector_codes.decoded(vector_codes.coded(df, books), books).select("row.row.vec_id", "row.error", "vector").collect()
    own = {v: np.floor(np.array(e) * 1024) for v, e in rows}
    assert len(out) == 60
    for r in out:
        assert ((own[r.vec_id] - np.array(r.vector) * 1024) ** 2).sum() == r.error


# --- phrases


def plain_phrases(rows, least=30, top=2000, longest=4):
    """Sorted (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(own)
            counts.update((lang, tuple(own[i : i + k])) for k in range(1, longest + 1) for i in range(len(own) - k + 1))
    frequent = {key: a for key, a in counts.items() if a >= least}
    out = []
    for lang in totals:
        found = []
        for (of, w), a in frequent.items():
            if of != lang or len(w) < 2:
                continue
            if any(
                100 * f >= 80 * a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
                for (other, v), f in frequent.items()
                if other == lang and len(v) > len(w)
            ):
                continue
            cuts = [(counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min((2000000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            found.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, w, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, w.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def spoken(seed, n):
    rng = random.Random(seed)
    common = "the of and New York City stock market very large Data é 東京 w$ x".split()
    rows = []
    for i in range(n):
        own = [rng.choice(common) for _ in range(rng.randrange(60))]
        own += ["New", "York", "City", "Hall"] * rng.randrange(3) + ["a\tb,", "end.\nof", "x:y", "\x0b", " z"]
        rng.shuffle(own[: len(own) // 2])
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), " ".join(own)))
    return [*rows, ("en", None), ("en", ""), (None, "!!!"), *[("de", "same same same same same " * 200)] * 3]


def phrase_docs(spark, rows):
    fields = [T.StructField(c, T.StringType()) for c in ("lang", "text", "word", "n", "key", "id", "left", "right", "rank", "phrase")]
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], T.StructType(fields))


@pytest.mark.parametrize("head, bits", [(phrases.HEAD, phrases.BITS), (5, 1 << 12), (0, 1 << 6)])
def test_phrases_equal_a_plain_version(spark, head, bits):
    """With a small head most ids are hashes; with few bits, many infrequent keys are counted for nothing."""
    rows = spoken(1, 700)
    got = phrases.collocations(phrase_docs(spark, rows), head=head, bits=bits).collect()
    expected = plain_phrases(rows)
    assert len(expected) > 30
    assert by_repr(got) == by_repr(expected)


def test_phrases_stop_at_top_with_ties(spark):
    rows = [("en", " . ".join(f"a{i} b{i}" for i in range(50)))] * 30
    got = phrases.collocations(phrase_docs(spark, rows), top=20).collect()
    assert by_repr(got) == by_repr(plain_phrases(rows, top=20)) and len(got) == 20


def test_phrases_of_dense_and_sparse_tiles(monkeypatch):
    monkeypatch.setattr(phrases, "SIDE", 8)
    monkeypatch.setattr(phrases, "GRID", 4)
    rng = np.random.default_rng(3)
    left, right = (rng.geometric(0.05, 5000).astype(np.int64) - 1 for _ in range(2))
    left[:50] += phrases.TAIL
    a, b, n = phrases.tiled_counts(left, right)
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == Counter(zip(left.tolist(), right.tolist(), strict=True))
    assert len(a) == len(set(zip(a.tolist(), b.tolist(), strict=True)))


def test_no_phrases(spark):
    assert phrases.collocations(phrase_docs(spark, [])).collect() == []
    assert phrases.collocations(phrase_docs(spark, [(None, None), ("en", "just once")])).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    rows = [("en", 1, ["a"], big), ("en", 1, ["b"], big + 1), ("en", 2, ["a", "b"], big - 7)]
    made = phrases._scored(spark.createDataFrame(rows, "lang string, k int, phrase array<string>, a long")).first()
    assert made.score == 2000000 * (big - 7) // (2 * big + 1)


# --- quality classifier


def test_classifier_on_held_out_documents(spark):
    got = {r.doc_id: r for r in registry.QUERIES["op11_quality_classifier"](spark, MIDDLE).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    test = [(got[r.doc_id].score, r.quality) for r in labels if got[r.doc_id].held_out]
    good, bad = [s for s, q in test if q == 1], [s for s, q in test if q == 0]
    assert len(good) > 40 and len(bad) > 5
    ordered = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    assert ordered > 0.97
    assert sum(s >= 0.3 for s in good) / len(good) > 0.95


def test_labels_of_held_out_documents_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality", "toxic")
    first, second = (quality_model.classified(docs, t).selectExpr("row.doc_id", "score").collect() for t in (labels, turned))
    assert by_repr(first) == by_repr(second)


def test_scores_are_those_of_the_plain_formula(spark):
    rows = awkward()
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(4, 1), (5, 1), (6, 1), (8, 0), (10, 0), (14, 0), (14, None), (15, 1), (15, 0), (None, 1)], "doc_id long, quality int")
    model = quality_model.trained(quality_model.sample_of(docs, labels))
    got = quality_model.scored(docs, model).selectExpr("row.doc_id", "score").collect()
    plain = []
    for doc_id, text in pairs(rows):
        own = quality_model.numbers(text or "")
        mean = model.weights[own].mean() if len(own) else 0.0
        plain.append((doc_id, 1 / (1 + math.exp(-mean - model.constant))))
    assert [(d, round(s, 12)) for d, s in by_repr(got)] == [(d, round(s, 12)) for d, s in by_repr(plain)]
    held = {d for d in (4, 5, 6, 8, 10, 14) if zlib.crc32(str(d).encode()) % 5 == 0}
    assert len(quality_model.sample_of(docs, labels)) == 6 - len(held)


def test_no_labels_and_no_documents(spark):
    docs, none = docs_of(spark, awkward()), spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_model.classified(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality_model.classified(docs_of(spark, []), labels).collect() == []


def test_sample_is_bounded(spark):
    docs = docs_of(spark, [(i, f"text number {i} " * 9, "a") for i in range(80)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    assert len(quality_model.sample_of(docs, labels, rows=10)) == 10
    assert len(quality_model.sample_of(docs, labels, size=2000)) < 10


def test_numbers_of_words_do_not_depend_on_where_they_stand():
    one, other = quality_model.numbers("Straße 日本"), quality_model.numbers("日本 Straße")
    assert sorted(one.tolist()) == sorted(other.tolist())
    marked = [f"<{w}>" for w in ("Straße", "日本")]
    assert len(one) == 2 + sum(max(0, len(w) - n + 1) for w in marked for n in quality_model.GRAMS)
    twice = quality_model.numbers("a a b a")
    assert (twice == quality_model.REPEAT).sum() == 1


def test_digest_of_codebooks_is_that_of_their_text(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = registry.QUERIES["op13_vector_codes"](spark, SMALL).collect()
    plain, text = plain_codes([tuple(r) for r in rows])
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted((v, *c) for (v, _), c in plain.items())
