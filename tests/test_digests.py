"""Snapshots with a tree of digests."""

import os
import random

import pytest
from conftest import bar, day, days, rows_of
from pyspark.sql import functions as F

from barflow.schemas import BAR_COLUMNS, ContractError
from barflow.sinks import digests as D


def written(bars, path, rows, parts=4):
    D.write_digested(bars(rows), str(path), parts)
    return str(path)


def some_bars():
    return [bar(s, d, 10.0 + i) for s in "ABCDEFGH" for i, d in enumerate(days("2021-11-01", 12, 30))]


def test_parents_are_the_sums_of_their_leaves(bars, spark, tmp_path):
    one = written(bars, tmp_path / "a", some_bars())
    other = written(bars, tmp_path / "b", some_bars()[::-1])
    whole = D.leaf_digests(bars(some_bars()).withColumn("leaf", F.lit("2021-0"))).drop("leaf")
    for path in (one, other):
        assert D.root_digest(D.read_leaves(spark, path)) == tuple(whole.first())
    assert D.unequal_leaves(D.read_leaves(spark, one), D.read_leaves(spark, other)).count() == 0
    assert D.changed_bars(spark, one, other).count() == 0


def test_one_changed_value_opens_one_leaf(bars, spark, tmp_path):
    rows = some_bars()
    changed = [{**r, "close": r["close"] + 1e-9} if i == 37 else r for i, r in enumerate(rows)]
    one, other = written(bars, tmp_path / "a", rows), written(bars, tmp_path / "b", changed)
    leaves = D.unequal_leaves(D.read_leaves(spark, one), D.read_leaves(spark, other))
    assert [r.change for r in leaves.collect()] == ["changed"]
    leaf = leaves.first().leaf
    # equal leaves are not opened: they may even be gone
    for path in (one, other):
        for name in os.listdir(f"{path}/bars"):
            if name.startswith("leaf=") and name != f"leaf={leaf}":
                for part in os.listdir(f"{path}/bars/{name}"):
                    with open(f"{path}/bars/{name}/{part}", "wb") as f:
                        f.write(b"not parquet")
    assert rows_of(D.changed_bars(spark, one, other)) == [(rows[37]["security_id"], rows[37]["date"], "changed", "close")]


def test_changes_equal_a_plain_comparison(bars, spark, tmp_path):
    rng = random.Random(4)
    rows = some_bars()
    nan = bar("N", "2022-01-01", adj_close=float("nan"), volume=None)
    held, kept, expected = [*rows, nan], [nan], []
    for r in rows:
        kind = rng.choice(["same"] * 6 + ["gone", "ticker", "both", "twice"])
        key = (r["security_id"], r["date"])
        if kind == "gone":
            expected.append((*key, "removed", None))
            continue
        kept.append({**r, **{"ticker": {"ticker": "Q"}, "both": {"open": 1.5, "volume": None}}.get(kind, {})})
        if kind in ("ticker", "both"):
            expected.append((*key, "changed", "ticker" if kind == "ticker" else "open|volume"))
        if kind == "twice":
            kept.append(kept[-1])
            expected.append((*key, "repeated", None))
    kept += [bar("Z", "2030-01-01"), bar("A", None)]
    expected += [("Z", day("2030-01-01"), "added", None), ("A", None, "added", None)]
    one, other = written(bars, tmp_path / "a", held), written(bars, tmp_path / "b", kept)
    assert rows_of(D.changed_bars(spark, one, other)) == sorted(expected, key=repr)


def test_a_load_checks_the_leaves_that_it_reads(bars, spark, tmp_path):
    rows = some_bars()
    path = written(bars, tmp_path / "a", rows)
    assert rows_of(D.load_digested(spark, path, parts=4), *BAR_COLUMNS) == rows_of(bars(rows), *BAR_COLUMNS)
    some = D.load_digested(spark, path, [2022], ["A", "C"], 4)
    assert rows_of(some, *BAR_COLUMNS) == rows_of(bars(rows).filter("year(date) = 2022 and security_id in ('A', 'C')"), *BAR_COLUMNS)
    # one more bar slips into a leaf of 2021
    leaf = next(n for n in os.listdir(f"{path}/bars") if n.startswith("leaf=2021"))
    bars([bar("A", "2021-11-02")]).write.mode("append").parquet(f"{path}/bars/{leaf}")
    with pytest.raises(ContractError, match="differs from its digests"):
        D.load_digested(spark, path, [2021], parts=4)
    assert D.load_digested(spark, path, [2022], parts=4).count() == sum(r["date"].year == 2022 for r in rows)


def test_no_bars(bars, spark, tmp_path):
    empty, some = written(bars, tmp_path / "a", []), written(bars, tmp_path / "b", some_bars()[:2])
    assert rows_of(D.changed_bars(spark, empty, some), "change") == [("added",)] * 2
    assert D.load_digested(spark, empty, parts=4).count() == 0
