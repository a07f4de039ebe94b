"""Each operator on awkward tables against its plain version."""

import hashlib

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import CLASHES, awkward, by_repr, docs_of, pairs, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barflow.llm import bpe_codec, decontaminate, line_dedup, lm_score, quality, simhash, substring, token_count, warc
from barflow.llm.automaton import SuffixAutomaton
from barflow.llm.components import components
from barflow.llm.cuckoo import CuckooFilter
from barflow.llm.queries import BYTE_BPE

ROWS = awkward()


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, ROWS).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def clash_kept(df):
    """The input's other columns come through unchanged."""
    assert {r[0] for r in df.select("row.*").select(CLASHES[-1]).collect()} == {f"x{len(CLASHES) - 1}"}


# -- near copies -------------------------------------------------------------


def test_simhash(docs, nothing, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 2)
    monkeypatch.setattr(simhash, "BLOCK", 3)
    out = simhash.near_duplicates(docs)
    clash_kept(out)
    got = out.select("doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")), "component_id").collect()
    assert by_repr(got) == by_repr(brute.near_groups(pairs(ROWS)))
    assert simhash.near_duplicates(nothing).collect() == []


def test_one_of_each_group(docs):
    kept = simhash.one_of_each(docs, simhash.CLOSE)
    assert kept.columns == docs.columns
    groups = brute.near_groups(pairs(ROWS))
    assert by_repr((r.doc_id,) for r in kept.collect()) == by_repr((g,) for g in {g for _, _, g in groups})


def test_similar_texts_meet(spark):
    base = prose(11, 400)
    rows = [(0, " ".join(base), "a")]
    for i in range(1, 12):
        own = list(base)
        for at in range(i, 400, 60):
            own[at] = f"new{i}x{at}"
        rows.append((i, " ".join(own), "a"))
    rows += [(100 + i, " ".join(prose(50 + i, 300)), "a") for i in range(20)]
    kept = {r.doc_id for r in simhash.one_of_each(docs_of(spark, rows)).collect()}
    assert kept == {0, *range(100, 120)}


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 6))
def test_trees_prune_no_neighbour(seed, depth):
    rng = np.random.default_rng(seed)
    marks = rng.integers(0, 1 << 63, (60, 1), dtype=np.uint64)
    near = marks.copy()
    for row in near:
        for bit in rng.choice(64, 4, replace=False):
            row[0] ^= np.uint64(1) << np.uint64(bit)
    both = np.concatenate([marks, near])
    trees = simhash.fit_trees(both, simhash.CLOSE, depth)
    met = set()
    for cut, nodes in zip(simhash.CLOSE.cuts(), trees, strict=True):
        for _, at, home in simhash.route(simhash._segment(both, cut), nodes, simhash.CLOSE.reach):
            held, asks = set(at[home].tolist()), set(at.tolist())
            met |= {i for i in range(60) if (i in held and i + 60 in asks) or (i in asks and i + 60 in held)}
    assert met == set(range(60))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(200, i) for i in range(101, 130)]
    edges = spark.createDataFrame([*chain, *star, (500, 500), (7, 3)], "a long, b long")
    root = {r.node: r.root for r in components(edges).collect()}
    assert len({root[i] for i in range(41)}) == 1
    assert len({root[i] for i in [200, *range(101, 130)]}) == 1
    assert root[0] != root[200]
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# -- quality -----------------------------------------------------------------


def test_quality_measures(docs, nothing):
    out = quality.quality_rules(docs)
    clash_kept(out)
    got = out.select("row.doc_id", *quality.MEASURES, "base_failed").collect()
    assert by_repr(got) == by_repr([(d, *brute.quality(t)) for d, t in pairs(ROWS)])
    assert quality.quality_rules(nothing).collect() == []


def test_bad_host_takes_its_documents_along(spark):
    fine = " ".join(prose(3, 50))
    rows = [(i, "bad", "spam") for i in range(60)] + [(100, fine, "spam"), (101, fine, "lone"), (102, fine, None)]
    rows += [(200 + i, fine, f"h{i % 7}") for i in range(70)]
    kept = quality.keep_quality(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {101, 102, *range(200, 270)}


def test_host_verdicts_follow_the_fitted_prior(spark):
    # many good hosts, one bad by much evidence, one by a single document only
    counts = {f"good{i}": (40, i % 4) for i in range(12)} | {"bad": (40, 39), "few": (1, 1), "half": (40, 20)}
    rows = []
    for host, (n, failed) in counts.items():
        rows += [(host, i < failed) for i in range(n)]
    judged = spark.createDataFrame(rows, "host string, base_failed boolean")
    rates = quality.host_rates(judged, {"base": "base_failed"})
    got = {r.host: r.base_rate for r in rates.collect()}
    raw = [f / n for n, f in counts.values()]
    mean = sum(raw) / len(raw)
    var = sum((r - mean) ** 2 for r in raw) / len(raw)
    strength = mean * (1 - mean) / var - 1
    for host, (n, failed) in counts.items():
        assert abs(got[host] - (failed + mean * strength) / (n + strength)) < 1e-12
    # all of the documents of "few" fail, but one does not condemn a host
    assert counts["few"][1] == counts["few"][0] and got["few"] < quality.HOST_LIMIT < got["bad"]
    assert [r.host for r in quality.rejected_hosts(rates, {"base": "base_failed"}).collect()] == ["bad"]

# -- scores ------------------------------------------------------------------


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_scores(docs, nothing, order):
    out = lm_score.backoff_scores(docs, order)
    clash_kept(out)
    got = out.select("row.doc_id", "n_words", "log_score").collect()
    exp = [(d, *s) for (d, _), s in zip(pairs(ROWS), brute.scores(pairs(ROWS), order), strict=True)]
    assert by_repr(got) == by_repr(exp)
    assert lm_score.backoff_scores(nothing, order).collect() == []


def test_scores_from_many_partitions_and_slices(spark, monkeypatch):
    """Counts beyond a byte, words of every document and words of one, in equal and unequal slices."""
    rows = [(i, " ".join(["the"] * (i % 5) + prose(i % 90, 30) + [f"own{i}"]), "a") for i in range(400)]
    rows += [(1000 + i, t, s) for i, t, s in rows[:50]]
    monkeypatch.setattr(lm_score, "PART_BYTES", 9000)
    docs = docs_of(spark, rows).repartition(3)
    out = lm_score.backoff_scores(docs).select("row.doc_id", "n_words", "log_score", "score").collect()
    exp = [(d, *s) for (d, _), s in zip(pairs(rows), brute.scores(pairs(rows), lm_score.ORDER), strict=True)]
    assert by_repr([r[:3] for r in out]) == by_repr(exp)
    assert all(abs(r.score - r.log_score / 1e6 / r.n_words) < 1e-12 for r in out)


def test_a_word_seen_once_is_told_from_a_frequent_one(spark):
    """No word is mapped to a common entry: fresh words score below known ones."""
    rows = [(i, " ".join(prose(i % 7, 200)), "a") for i in range(60)]
    rows += [(100, " ".join(f"fresh{i}" for i in range(200)), "a"), (101, " ".join(prose(3, 200)), "a")]
    got = {r[0]: r[1] for r in lm_score.backoff_scores(docs_of(spark, rows)).select("row.doc_id", "score").collect()}
    assert min(got, key=got.get) == 100 and got[101] > got[100] + 5


# -- substrings --------------------------------------------------------------


@pytest.mark.parametrize("hot", [substring.HOT, 1])
def test_substrings(docs, nothing, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    out = substring.dedup_substrings(docs)
    clash_kept(out)
    got = out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert by_repr(got) == by_repr(brute.substrings(pairs(ROWS)))
    assert substring.dedup_substrings(nothing).collect() == []


def test_substrings_of_few_words(spark):
    rows = [(i, " ".join(prose(i % 3, 30)[i % 5 :] + prose(9, 12)), "a") for i in range(30)]
    got = substring.dedup_substrings(docs_of(spark, rows), 6).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert by_repr(got.collect()) == by_repr(brute.substrings(pairs(rows), 6))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc", max_size=25), max_size=5), st.text("abc", max_size=25))
def test_matching_statistics(held, probe):
    automaton = SuffixAutomaton()
    for text in held:
        automaton.add(text)
    expected = [max(k for k in range(i + 2) if any(probe[i + 1 - k : i + 1] in t for t in held) or k == 0) for i in range(len(probe))]
    assert list(automaton.matching(probe)) == expected


# -- tokens ------------------------------------------------------------------


def test_token_counts(docs, nothing, library):
    out = token_count.token_counts(docs, BYTE_BPE)
    clash_kept(out)
    exp = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in pairs(ROWS)]
    assert by_repr(out.select("row.doc_id", "n_bytes", "n_tokens").collect()) == by_repr(exp)
    assert token_count.token_counts(nothing, BYTE_BPE).collect() == []


def test_other_tokenizers(docs):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    got = token_count.token_counts(docs, model).select("row.doc_id", "n_tokens").collect()
    assert by_repr(got) == by_repr([(d, len(pieces.encode(t or ""))) for d, t in pairs(ROWS)])
    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    got = token_count.token_counts(docs, path).select("row.doc_id", "n_tokens").collect()
    assert by_repr(got) == by_repr([(d, len(other.encode(t or "", add_special_tokens=False).ids)) for d, t in pairs(ROWS)])


ALPHABET = ["a", "the", "é", "日本", "'s", "12", "!!", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\u3000", "<|endoftext|>", "😀", "_", "ſ"]


@pytest.fixture(scope="module")
def counter():
    return token_count.Counter(BYTE_BPE, token_count.frequent_lengths(BYTE_BPE))


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(BYTE_BPE)


@settings(max_examples=400, deadline=None)
@given(parts=st.lists(st.sampled_from(ALPHABET), max_size=300))
def test_any_text_encodes_as_the_library_does(parts, library, counter, codec):
    text = "".join(parts)
    ids = library.encode(text, add_special_tokens=False).ids
    assert counter.count(text) == len(ids)
    assert codec.encode(text) == ids
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_codec(docs, nothing, library):
    out = bpe_codec.digests(docs, BYTE_BPE)
    clash_kept(out)
    exp = []
    for d, t in pairs(ROWS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        exp.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), brute.sha(t or "")))
    assert by_repr(out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == by_repr(exp)
    whole = bpe_codec.encoded(docs, BYTE_BPE).select("row.doc_id", "decoded").collect()
    assert by_repr(whole) == by_repr([(d, t or "") for d, t in pairs(ROWS)])
    assert bpe_codec.digests(nothing, BYTE_BPE).collect() == []


def test_cuts_depend_on_content_only():
    text = " ".join(prose(7, 4000)).encode()
    chunks = lambda data: {data[a:b] for a, b in zip([0, *bpe_codec.cuts(data)], bpe_codec.cuts(data), strict=False)}
    own, moved = chunks(text), chunks(b"a few other words " + text)
    assert len(own) > 20
    assert len(own & moved) > 0.8 * len(own)


# -- benchmark ---------------------------------------------------------------

ITEMS = [
    (1, " ".join(prose(1, 120)[30:70])),
    (2, "short text"),
    (3, "Own WORDS, here!"),
    (3, "Own WORDS, here!"),
    (4, None),
    (5, ""),
    (None, "another ending"),
    (10, "nowhere to be found in any of these documents at all, not once"),
]


def test_contamination(spark, docs, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.contamination(docs, items)
    clash_kept(out)
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out.select("row.doc_id", "n_words", "n_hit", "items").collect()]
    assert by_repr(got) == by_repr(brute.contamination(pairs(ROWS), ITEMS))
    clean = decontaminate.decontaminated(docs, items)
    assert clean.columns == docs.columns
    exp = [d for d, _, hit, _ in brute.contamination(pairs(ROWS), ITEMS) if not hit]
    assert by_repr((r.doc_id,) for r in clean.collect()) == by_repr((d,) for d in exp)
    assert decontaminate.contamination(nothing, items).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


# -- lines -------------------------------------------------------------------


def test_lines(docs, nothing):
    out = line_dedup.dedup_lines(docs)
    clash_kept(out)
    got = out.select("row.doc_id", "n_lines", "n_dropped", F.col("kept").cast("string")).collect()
    assert by_repr(got) == by_repr(brute.lines(pairs(ROWS)))
    assert line_dedup.dedup_lines(nothing).collect() == []


def test_line_store_is_reversible(spark):
    line = "a line that is long enough to be counted, number {}"
    rows = [(i, "\n".join(line.format(k) for k in range(20) if (i + k) % 4), "a") for i in range(12)]
    one, two = docs_of(spark, rows[:8]), docs_of(spark, rows[8:])
    first = line_dedup.line_store(one)
    both = first.insert(two)
    keys = lambda store: by_repr(store.frequent.select("hi", "lo", "n_docs", "last_doc").collect())
    exp = brute.lines(pairs(rows))
    got = line_dedup.dedup_lines(docs_of(spark, rows), both).select("row.doc_id", "n_lines", "n_dropped", F.col("kept").cast("string"))
    assert by_repr(got.collect()) == by_repr(exp)
    back = both.delete(two.select("doc_id"))
    assert keys(back) == keys(first)
    got = line_dedup.dedup_lines(one, back).select("row.doc_id", "n_lines", "n_dropped", F.col("kept").cast("string"))
    assert by_repr(got.collect()) == by_repr(brute.lines(pairs(rows[:8])))


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 3000))
def test_cuckoo_filter(seed, n):
    rng = np.random.default_rng(seed)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    made = CuckooFilter.from_bytes(CuckooFilter.of(keys).to_bytes())
    assert made.contains(keys).all()
    gone, left = keys[::2], keys[1::2]
    made.delete(gone)
    assert made.contains(left).all()
    assert made.contains(gone).mean() < 0.02 if len(gone) > 500 else True
    assert made.insert(gone)
    assert made.contains(keys).all()


# -- archives ----------------------------------------------------------------


def page_rows():
    big = "<p>" + "payload " * 400
    rng = np.random.default_rng(5)
    noise = "".join(map(chr, rng.integers(32, 500, 60_000)))
    return [
        (0, "http://a.example/", big),
        (1, None, big),
        (2, "http://b.example/x\r\ny", big),
        (3, "http://c.example/", None),
        (4, "http://d.example/", ""),
        (5, "http://e.example/", "small"),
        (6, "http://f.example/", "small"),
        (None, "http://g.example/", big),
        (7, "http://h.example/", noise),
        (7, "http://h.example/", noise),
        (8, "http://i.example/", "WARC/1.0\r\n\r\n" * 200),
    ]


@pytest.mark.parametrize("split", [500, 5000, warc.SPLIT_BYTES])
def test_warc_round_trip(spark, tmp_path, split):
    pages = spark.createDataFrame([(*r, "x") for r in page_rows()], "page_id long, url string, html string, payload string")
    warc.write_warc(pages.repartition(2), str(tmp_path / "w"))
    records = warc.read_warc(spark, str(tmp_path / "w"), split).filter("warc_type <> 'warcinfo'").collect()
    got = [(r.record_id, r.warc_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in records]
    exp = []
    for page_id, _, html in page_rows():
        data = (html or "").encode()
        last = max((p for p, _, h in page_rows() if h == html and p is not None), default=None)
        revisit = len(data) >= 1000 and page_id != last
        digest = "sha1:" + hashlib.sha1(data).hexdigest()
        refers = warc.record_uri(last) if revisit else None
        exp.append((warc.record_uri(page_id), "revisit" if revisit else "response", refers, len(data), digest, b"" if revisit else data))
    assert by_repr(got) == by_repr(exp)


def test_warc_of_no_pages(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).filter("warc_type <> 'warcinfo'").collect() == []


def test_member_ends_with_zero():
    assert warc._member(b"x" * (1 << 24), 1)[-1] == 0
    assert warc._member(b"x", 6)[-1] == 0
