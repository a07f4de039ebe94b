"""A line store that grows by inserts."""

from llm_tables import by_repr, docs_of

from barflow.llm import line_dedup


def test_shards_follow_the_frequent_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 10)
    lines = [f"line {i} of a passage that is long enough to be looked at" for i in range(100)]
    few = docs_of(spark, [(0, "\n".join(lines), "a")])
    more = docs_of(spark, [(i, "\n".join(lines), "a") for i in range(1, 6)])
    first = line_dedup.line_store(few)
    assert first.shards == 1
    grown = first.insert(more)
    assert grown.shards == 10 and grown.filters.count() > 1
    refs = grown.references
    whole = line_dedup.line_store(few.unionByName(more))
    dropped = [line_dedup.dropped_keys(store, refs).selectExpr("doc_id", "size(dropped)").collect() for store in (grown, whole)]
    assert by_repr(dropped[0]) == by_repr(dropped[1]) == [(i, 100) for i in range(5)]
