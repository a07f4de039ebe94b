"""One security, and one of its dates, owns most rows; results must stay whole."""

from collections import defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from barflow.operators import continuity as C
from barflow.operators import normalize as N
from barflow.operators import windows as W

DATES = 40


@pytest.fixture(scope="module")
def trades(spark):
    """200,000 source rows: two thirds of one security, a third of one date of it."""
    n = F.col("id")
    return spark.range(200_000).select(
        F.expr("date_add(DATE'2024-01-01', cast(CASE WHEN id % 3 = 0 THEN 7 ELSE (id * 17) % 40 END as int))").alias("date"),
        F.when(n % 3 < 2, "HOT").otherwise(F.concat(F.lit("S"), ((n * 31) % 50).cast("string"))).alias("security_id"),
        F.lit("T").alias("ticker"),
        *[(F.lit(10.0) + n % 5).alias(c) for c in ("open", "high", "low", "close", "adj_close")],
        (n % 100).alias("volume"),
        ((n * 7919) % 200_000).alias("src_ord"),
    )


@pytest.fixture(scope="module")
def plain(trades):
    return [tuple(r) for r in trades.select("security_id", "date", "close", "src_ord").collect()]


def test_last_row_per_date_is_exact(trades, plain):
    want = {}
    for sid, d, close, o in plain:
        if o >= want.get((sid, d), (-1, 0))[0]:
            want[(sid, d)] = (o, close)
    out = N.normalize_history(trades)
    assert rows_of(out, "security_id", "date", "close") == sorted(((s, d, c) for (s, d), (_, c) in want.items()), key=repr)
    first = N.dedupe_keep(trades, ["security_id", "date"], ["src_ord"], keep="first")
    assert first.count() == len(want)


def test_stored_order_check_is_exact(trades, plain):
    by_id = defaultdict(list)
    for sid, d, _, o in plain:
        by_id[sid].append((o, d))
    want = []
    for sid, rows in by_id.items():
        rows.sort()
        want.append((sid, sum(b[1] <= a[1] for a, b in zip(rows, rows[1:]))))
    assert rows_of(N.monotonic_check(trades, ["security_id"], segment_rows=5_000), "security_id", "inversions") == sorted(want, key=repr)


def test_counts_and_gaps_over_repeats(trades, plain):
    labelled = N.split_incomplete_checks(N.split_incomplete(trades))
    assert labelled.agg(F.sum("valid_rows")).first()[0] == len(plain)
    bars = N.accepted(N.normalize_history(trades))
    dates = defaultdict(set)
    for sid, d, *_ in plain:
        dates[sid].add(d)
    members = bars.select("security_id", "ticker").distinct()
    got = dict(rows_of(W.readiness(members, trades, None, DATES, 1), "security_id", "available_bars"))
    assert got == {s: len(v) for s, v in dates.items()}
    days = sorted(set().union(*dates.values()))
    gaps = C.session_gaps(trades, days[0], days[-1])
    want = [(s, d) for s, v in dates.items() if days[-1] in v for d in days[1:] if d not in v]
    assert rows_of(gaps) == sorted(want, key=repr)
