"""The registered queries and the pipeline on a whole small table."""

import brute
import corpus_pipeline
import duckdb
import pytest
from llm_tables import SMALL, awkward, by_repr, docs_of, pairs
from test_llm_near_sets import plain_kept

from barflow.llm import registry

registry.load()
TABLES = "documents pages benchmark embeddings labels".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    rel = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert by_repr(df.select(*columns).collect()) == by_repr(tuple(r[i] for i in at) for r in rel.fetchall())


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = registry.QUERIES["op1_simhash"](spark, SMALL).collect()
    assert by_repr(got) == by_repr(brute.near_groups(docs))


def test_token_queries(spark):
    from tokenizers import Tokenizer

    from barflow.llm.queries import BYTE_BPE

    library = Tokenizer.from_file(BYTE_BPE)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    ids = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in docs}
    counted = registry.QUERIES["op5_token_counts"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in counted} == {
        d: (len((t or "").encode()), len(ids[d]), len(ids[d]) > 1024) for d, t in docs
    }
    coded = registry.QUERIES["op9_bpe_codec"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in coded} == {
        d: (len(ids[d]), brute.sha(",".join(map(str, ids[d]))), brute.sha(t or "")) for d, t in docs
    }


def test_quality_uses_no_python(spark):
    plan = registry.QUERIES["op2_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def plain_pipeline(docs, items):
    kept = [(d, t) for d, t in docs if not brute.quality(t)[5]]
    kept = [(d, text) for d, _, _, text in brute.lines(kept)]
    stay = plain_kept(kept)
    kept = [p for i, p in enumerate(kept) if i in stay]
    hits = [hit for _, _, hit, _ in brute.contamination(kept, items)]
    return [p for p, hit in zip(kept, hits, strict=True) if not hit]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    got = corpus_pipeline.run(spark, SMALL).select("doc_id", "decoded_sha256").collect()
    assert by_repr(got) == by_repr((d, brute.sha(t)) for d, t in plain_pipeline(docs, items))


def test_stages_keep_columns_and_stand_awkward_rows(spark, tmp_path):
    rows = awkward()
    docs = docs_of(spark, rows)
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if at + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(at)))
        docs = spark.read.parquet(str(tmp_path / str(at)))
    kept = [(d, t) for d, t in pairs(rows) if not brute.quality(t)[5]]
    assert 0 < docs.count() < len(kept)
    empty = docs_of(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []
