"""The clustered bar store and the stored window, against rebuilds from all bars."""

import random
import uuid

import pytest
from conftest import bar, day, days, rows_of
from pyspark.sql import functions as F

from barflow.operators import ema as E
from barflow.operators import tails as TL
from barflow.operators import windows as W
from barflow.schemas import BAR_COLUMNS, ContractError
from barflow.sinks import store as ST


def name():
    return f"store_{uuid.uuid4().hex}"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_scans(plan):
    """Scans of stores that stand below a shuffle."""
    found, above = [], []
    for line in plan.splitlines():
        node = line.lstrip(" :+-*()0123456789")
        depth = len(line) - len(node)
        above = [d for d in above if d < depth]
        if node.startswith("Exchange"):
            above.append(depth)
        if node.startswith("FileScan parquet spark_catalog") and above:
            found.append(node)
    return found


@pytest.fixture
def stored(bars, spark, tmp_path):
    rows = [bar(s, d, 10.0 + i % 7) for s in "ABCDEF" for i, d in enumerate(days("2023-01-01", 260))]
    table = name()
    return ST.create_bar_store(bars(rows), table, str(tmp_path / "bars"), 4), table, bars(rows)


def test_stored_bars_meet_without_a_shuffle(stored, spark):
    bars, _, plain = stored
    made = {
        "tail": W.rolling_tail(bars, 20),
        "counts": TL.bar_counts(bars),
        "ema": E.ema_bootstrap(bars),
        "facts": bars.groupBy("security_id").agg(F.max("date"), F.count("*")),
    }
    for what, df in made.items():
        assert "Exchange" not in plan_of(df), what
    assert rows_of(made["tail"]) == rows_of(W.rolling_tail(plain, 20))
    assert rows_of(made["ema"]) == rows_of(E.ema_bootstrap(plain))
    assert "Exchange" in plan_of(W.rolling_tail(plain, 20))


def test_history_gate_leaves_the_bars_in_their_buckets(stored, spark, bars, tmp_path):
    held, _, plain = stored
    # read from files, so that their size is known when the join is planned
    bars([bar("X", d) for d in days("2023-01-01", 260)]).write.parquet(str(tmp_path / "benchmark"))
    benchmark = spark.read.parquet(str(tmp_path / "benchmark"))
    names = spark.createDataFrame([(s, f"T{s}") for s in "ABCDEF"], "security_id string, ticker string")
    names.write.parquet(str(tmp_path / "expected"))
    expected = spark.read.parquet(str(tmp_path / "expected"))
    gate = W.history_gate(held, benchmark, expected)
    assert rows_of(gate) == rows_of(W.history_gate(plain, benchmark, expected))
    # the expected list is moved to the buckets, never the bars
    assert shuffled_scans(plan_of(gate)) == []
    assert shuffled_scans(plan_of(W.rolling_tail(held.repartition(3, "date"), 5))) != []


def test_store_keeps_one_bar_a_date_and_grows(bars, spark, tmp_path):
    table, path = name(), str(tmp_path / "bars")
    first = [bar("A", "2024-01-02", 10.0), bar("A", "2024-01-02", 11.0), bar("B", None), bar("B", "2024-01-02")]
    assert ST.create_bar_store(bars(first), table, path, 2).count() == 2
    more = [bar("A", "2024-01-02", 99.0), bar("A", "2024-01-03", 12.0), bar("A", "2024-01-03", 12.0), bar("N", "2024-01-03")]
    grown = ST.append_to_bar_store(spark, table, bars(more))
    assert rows_of(grown, "security_id", "date", "close") == [
        ("A", day("2024-01-02"), 11.0), ("A", day("2024-01-03"), 12.0), ("B", day("2024-01-02"), 10.0), ("N", day("2024-01-03"), 10.0),
    ]
    assert "Exchange" not in plan_of(W.rolling_tail(grown, 1))
    assert rows_of(ST.append_to_bar_store(spark, table, bars(more))) == rows_of(grown)
    again = ST.open_bar_store(spark, name(), path, 2)
    assert rows_of(again.select(*BAR_COLUMNS)) == rows_of(grown.select(*BAR_COLUMNS))
    assert "Exchange" not in plan_of(W.rolling_tail(again, 1))
    with pytest.raises(Exception, match="exists"):
        ST.create_bar_store(bars(first), table, path, 2)


def test_a_security_with_most_rows_adds_no_more_than_its_dates(bars, spark, tmp_path):
    """Two securities of 200,000 and 10 rows on the same ten dates take the same room."""
    hot = spark.range(200_000).select(
        F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 10).cast("int")).alias("date"), F.lit("H").alias("security_id"), F.lit("TH").alias("ticker"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "adj_close")], F.col("id").alias("volume"),
    )
    cold = bars([bar("C", d) for d in days("2024-01-01", 10)])
    held = ST.create_bar_store(hot.unionByName(cold), name(), str(tmp_path / "bars"), 4)
    assert rows_of(held.groupBy("security_id").count()) == [("C", 10), ("H", 10)]
    assert held.filter("security_id = 'H'").agg(F.min("volume")).first()[0] == 199_990


def test_an_unclustered_table_is_refused(bars, spark, tmp_path):
    table = name()
    bars([bar("A", "2024-01-02")]).write.option("path", str(tmp_path / "t")).saveAsTable(table)
    with pytest.raises(ContractError, match="not clustered"):
        ST.append_to_bar_store(spark, table, bars([bar("A", "2024-01-03")]))


def test_bucket_count():
    assert [ST.bucket_count(n) for n in (0, 1, ST.BUCKET_BARS, ST.BUCKET_BARS + 1)] == [1, 1, 1, 2]


@pytest.mark.parametrize("seed", range(3))
def test_window_follows_any_sequence_of_changes(bars, spark, seed):
    """Additions, backfills, withdrawals and new securities: the window and counts equal those of all bars."""
    rng, n = random.Random(seed), 5
    every = days("2024-01-01", 25)
    history = {(s, d): 10.0 + rng.randrange(9) for s in "ABC" for d in every[:12] if rng.random() < 0.7}
    table = lambda held: bars([bar(s, d, c) for (s, d), c in held.items()])
    tail, counts = W.rolling_tail(table(history), n), TL.bar_counts(table(history))
    for _ in range(3):
        free = [(s, d) for s in "ABCD" for d in every if (s, d) not in history]
        added = {k: 20.0 + rng.randrange(9) for k in rng.sample(free, 8)}
        gone = rng.sample(sorted(history), 4)
        history.update(added)
        tail, counts = TL.advance_tail(tail, table(added), n), TL.advance_counts(counts, table(added))
        lost = table({k: history.pop(k) for k in gone})
        tail, counts = TL.withdraw_from_tail(tail, table(history), lost, n), TL.advance_counts(counts, lost.limit(0), lost)
        tail, counts = (bars([r.asDict() for r in tail.collect()]), spark.createDataFrame(counts.collect(), counts.schema))
    assert rows_of(tail, *BAR_COLUMNS) == rows_of(W.rolling_tail(table(history), n), *BAR_COLUMNS)
    members = spark.createDataFrame([(s, s) for s in "ABCDE"], "security_id string, ticker string")
    assert rows_of(TL.readiness_from_tail(members, tail, counts, None, n, 3)) == rows_of(W.readiness(members, table(history), None, n, 3))


def test_window_keeps_stored_bars_and_restates_tickers(bars, spark):
    tail = bars([bar("A", "2024-01-02", 10.0), bar("B", "2024-01-02")])
    after = TL.advance_tail(tail, bars([bar("A", "2024-01-02", 99.0), bar("A", None)]), 3)
    assert rows_of(after) == rows_of(tail)
    names = spark.createDataFrame([("A", "NEW"), ("Z", "Q")], "security_id string, ticker string")
    assert rows_of(TL.restate_tickers(tail, names), "security_id", "ticker") == [("A", "NEW"), ("B", "TB")]


def test_window_update_reads_no_history(bars, spark, tmp_path):
    W.rolling_tail(bars([bar("A", d) for d in days("2024-01-01", 9)]), 5).write.parquet(str(tmp_path / "tail"))
    bars([bar("A", "2024-02-01")]).write.parquet(str(tmp_path / "new"))
    tail, new = (spark.read.parquet(str(tmp_path / p)) for p in ("tail", "new"))
    plan = plan_of(TL.advance_tail(tail, new, 5))
    assert plan.count("FileScan") == 2 * (2 if "== Initial Plan ==" in plan else 1)
