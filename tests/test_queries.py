"""Every registered query: against its SQL at the smallest scale, and its plan's shape."""

import datetime as dt
import math
import re

import duckdb
import pytest

import __spark_entry__ as spark_entry
from barflow import session
from barflow.plans import catalog, file_queries, fixtures, universe_queries
from barflow.sinks import publish

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# the library's own queries; those of subpackages have tests beside them
QUERIES = {name: fn for name, fn in spark_entry.queries().items() if name in catalog.QUERIES}
ORACLES = {name: sql for name, sql in spark_entry.oracle_sql().items() if name in catalog.QUERIES}

# Shapes that do not scale: all pairs, or one task for everything.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


# the slices of parity_metrics are one group, of a size that the number range bounds
BOUNDED_WINDOW = {"parity_metrics"}


def window_in_one_task(line):
    """A window node prints functions, then partition keys, then order; empty lists are left out."""
    if not line.lstrip(" :+-*()0123456789").startswith("Window ["):
        return False
    lists = line.split("], [")
    return len(lists) < 2 or re.search(r" (ASC|DESC) NULLS ", lists[1]) is not None


def test_window_shape_check():
    assert window_in_one_task("+- Window [sum(n#1L) windowspecdefinition(x) AS t#2L]")
    assert window_in_one_task("+- Window [sum(n#1L) AS t#2L], [d#3 ASC NULLS FIRST]")
    assert not window_in_one_task("+- Window [sum(n#1L) AS t#2L], [id#4], [d#3 ASC NULLS FIRST]")
    assert not window_in_one_task("+- Window [sum(n#1L) AS t#2L], [id#4]")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value) if isinstance(value, dt.date) else value


def ordered(rows, columns, wanted):
    at = [columns.index(c) for c in wanted]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = ordered([tuple(r) for r in df.collect()], df.columns, columns)
    if name in ORACLES:
        rel = duck.execute(ORACLES[name])
        names = [d[0] for d in rel.description]
        assert sorted(names) == columns
        assert got == ordered(rel.fetchall(), names, columns)
    else:
        assert got
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [shape for shape in FORBIDDEN if shape in plan] == []
    if name not in BOUNDED_WINDOW:
        assert [line for line in plan.splitlines() if window_in_one_task(line)] == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry_runs(spark):
    assert {r["trend"] for r in spark_entry.entry(spark).collect()} <= {"STACKED_UP", "STACKED_DOWN", "MIXED"}


ONCE = [
    "benchmark_merge", "daily_update_rolling_incremental", "ema_promotion", "fingerprint", "freshness_flags", "merge_replace_bad",
    "set_reduction_diff", "window_advance_diff",
]


@pytest.mark.parametrize("name", ONCE)
def test_bars_are_derived_once(spark, monkeypatch, name):
    """What reads the bars several times reads the written ones."""
    derived, keyed = [], fixtures.keyed_bars
    monkeypatch.setattr(fixtures, "keyed_bars", lambda *a: derived.append(1) or keyed(*a))
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert len(derived) == 1 and "l_extendedprice" not in plan


NARROW = {"ema_promotion": ["date", "security_id", "ticker", "adj_close"], "freshness_flags": ["date", "security_id", "ticker"]}


@pytest.mark.parametrize("name", sorted(NARROW))
def test_only_columns_in_use_are_written(spark, monkeypatch, name):
    """Prices and volume that a query never reads are not derived, moved and written for it."""
    written, keep = [], session.clustered

    def noting(df, label):
        written.append(df.columns)
        return keep(df, label)

    for module in (file_queries, universe_queries):
        monkeypatch.setattr(module, "clustered", noting)
    QUERIES[name](spark, FOLDER).collect()
    assert written and all(set(columns) <= set(NARROW[name]) for columns in written)


def test_bad_bars_are_judged_by_plain_conditions(spark):
    """Rule names, which nobody reads there, are not gathered for every bar; only bars with evidence are grouped."""
    plan = QUERIES["merge_replace_bad"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "nonpositive_price" not in plan and plan.count("LeftSemi") == 2


def test_fingerprint_variants_are_hashed_once_in_any_number_of_tasks(spark, monkeypatch):
    plans, keep = [], publish.fingerprint_frame

    def noting(df, columns):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, columns)

    monkeypatch.setattr(publish, "fingerprint_frame", noting)
    assert QUERIES["fingerprint"](spark, FOLDER).count() == 4
    assert len(plans) == 4
    dealt = [p for p in plans if "RepartitionByExpression [date" in p]
    assert len(dealt) == 1 and not re.search(r"RepartitionByExpression \[date#\d+\], \d", dealt[0])
