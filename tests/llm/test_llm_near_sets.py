"""Near-duplicate removal against the exact Jaccard similarity of all pairs."""

import random

import corpus_pipeline
import pytest
from llm_tables import SMALL, awkward, by_repr, docs_of, pairs, prose

from barflow.llm import near_sets, simhash


def plain_sets(docs):
    out = []
    for _, text in docs:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return out


def plain_kept(docs):
    """Indexes that stay: the smallest doc_id of each group linked at 0.8 or more."""
    sets, group = plain_sets(docs), list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for i, g in enumerate(group):
        rank = (docs[i][0] is None, docs[i][0] or 0, i)
        first[g] = min(rank, first.get(g, rank))
    return {rank[2] for rank in first.values()}


def edited(base, seed, changes):
    """The words with ``changes`` of them replaced, far enough apart to change five shingles each."""
    rng, own = random.Random(seed), list(base)
    for k, at in enumerate(rng.sample(range(5, len(base) - 5, 6), changes)):
        own[at] = f"new{seed}x{k}"
    return own


def around_the_limit():
    """Pairs of texts of 364 words at similarities of 0.80 (8 changes) and just below (9)."""
    rows = []
    for i in range(60):
        base = prose(1000 + i, 364)
        rows.append((2 * i, " ".join(base), "a"))
        rows.append((2 * i + 1, " ".join(edited(base, i, 8 + i % 2)), "a"))
    return rows


@pytest.mark.parametrize("block", [near_sets.BLOCK, 16])
def test_links_by_exact_similarity(spark, monkeypatch, block):
    monkeypatch.setattr(near_sets, "BLOCK", block)
    base = prose(7, 150)
    rows = around_the_limit() + awkward()
    rows += [(1000 + i, " ".join(edited(base, 500 + i, 1 + i % 5)), "a") for i in range(40)]
    out = near_sets.one_of_each(docs_of(spark, rows))
    kept = plain_kept(pairs(rows))
    assert by_repr((r.doc_id, r.text) for r in out.collect()) == by_repr(pairs(rows)[i] for i in kept)
    assert all(2 * i + 1 in kept for i in range(1, 60, 2)) and not any(2 * i + 1 in kept for i in range(0, 60, 2))


def test_stage_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    out = corpus_pipeline.near_stage(spark, docs, SMALL)
    assert out.columns == docs.columns
    assert by_repr((r.doc_id,) for r in out.collect()) == by_repr((rows[i][0],) for i in plain_kept(rows))


def test_no_rows(spark):
    assert near_sets.one_of_each(docs_of(spark, [])).collect() == []


def test_work_does_not_grow_with_the_square_of_a_shared_line(spark, monkeypatch):
    """Unlike texts behind one common line: its shingles leave the prefixes, so hardly any pair of them is compared."""
    line = " ".join(prose(77, 12))
    rows = [(i, line + " " + " ".join(f"w{i}x{j}" for j in range(20)), "a") for i in range(20_000)]
    made = []
    write = near_sets.staged

    def counted(df, label, *codec):
        out = write(df, label, *codec)
        if label == "postings":
            made.append(out.groupBy("g").count().agg({"count": "max"}).first()[0] or 0)
        return out

    monkeypatch.setattr(near_sets, "staged", counted)
    assert near_sets.one_of_each(docs_of(spark, rows)).count() == len(rows)
    assert len(made) == 1 and made[0] < 50


def apart(one, other):
    return (simhash.fingerprint(one.encode())[0] ^ simhash.fingerprint(other.encode())[0]).bit_count()


def test_forest_of_fingerprints_finds_copies_and_the_exact_check_follows(spark, monkeypatch):
    """Without the search by shingles, near copies still meet by close fingerprints; unlike texts that meet so both stay."""
    monkeypatch.setattr(near_sets, "prefix", lambda n: 0)
    rows, close, unlike = [], [], []
    for i in range(8):
        base = prose(3000 + i, 400)
        texts = [" ".join(base), " ".join(edited(base, i, 1))]
        close.append(apart(*texts) <= simhash.CLOSE.radius)
        rows += [(2 * i + k, text, "a") for k, text in enumerate(texts)]
    for i in range(400):
        base = prose(5000 + i, 60)
        texts = [" ".join(base), " ".join(edited(base, i, 2))]
        if apart(*texts) <= simhash.CLOSE.radius:
            unlike += texts
    rows += [(100 + i, text, "a") for i, text in enumerate(unlike)]
    assert any(close) and unlike
    gone = {r[0] for r in rows} - {r.doc_id for r in near_sets.one_of_each(docs_of(spark, rows)).collect()}
    assert gone == {2 * i + 1 for i, near in enumerate(close) if near}


def test_forest_searches_the_fingerprints_of_all_documents_of_a_set(spark, monkeypatch):
    """Texts of equal sets may repeat other parts and so have other fingerprints; a copy that is near to one of them only is found."""
    monkeypatch.setattr(near_sets, "prefix", lambda n: 0)
    rows, found = [], set()
    for i in range(12):
        ring = prose(7000 + i, 300)
        once, again = ring + ring[:4], ring + ring[:154]
        texts = [" ".join(once), " ".join(again), " ".join([*again[:420], f"new{i}", *again[421:]])]
        assert plain_sets([(0, texts[0])]) == plain_sets([(0, texts[1])])
        if apart(texts[0], texts[2]) > simhash.CLOSE.radius >= apart(texts[1], texts[2]):
            found.add(3 * i)
            rows += [(3 * i + k, text, "a") for k, text in enumerate(texts)]
    assert found
    assert {r.doc_id for r in near_sets.one_of_each(docs_of(spark, rows)).collect()} == found
