import hashlib

import numpy as np
import pytest
from conftest import bar, day, days, rows_of
from pyspark.sql import functions as F

from barflow.operators import reconcile as R


def test_provider_compare(bars):
    a = bars([bar("A", "2024-01-01", 11.0, volume=110), bar("A", "2024-01-02"), bar("A", "2024-01-03")])
    b = bars([bar("A", "2024-01-01", 10.0), bar("A", "2024-01-03", high=1.0), bar("A", "2024-01-04"), bar("A", "2024-01-05", volume=-1)])
    out = {r["date"]: r for r in R.provider_compare(a, b).collect()}
    first = out[day("2024-01-01")]
    assert (first["row_class"], first["close_delta"], first["close_relative"], first["volume_delta"]) == ("common", 1.0, 0.1, 10.0)
    assert [out[d]["row_class"] for d in days("2024-01-02", 4)] == ["only_in_a", "only_in_a_b_invalid", "only_in_b", "b_invalid"]
    row = R.provider_compare_summary(R.provider_compare(a, b)).first().asDict()
    assert row == {
        "security_id": "A", "common_dates": 1, "dates_only_in_a": 2, "dates_only_in_b": 1, "b_invalid_dates": 2,
        "a_latest_date": day("2024-01-03"), "b_latest_valid_date": day("2024-01-04"), "b_latest_observed_date": day("2024-01-05"),
    }


def test_relative_delta_of_zero_is_null(bars):
    a, b = bars([bar("A", "2024-01-01", volume=5)]), bars([bar("A", "2024-01-01", volume=0, adj_close=None)])
    row = R.provider_compare(a, b).first()
    assert (row["row_class"], row["volume_delta"], row["volume_relative"], row["adj_close_delta"]) == ("common", 5.0, None, None)


def test_parity_metrics(bars):
    d = days("2024-01-01", 40)
    a = bars([bar("A", x, 100.0) for x in d] + [bar("A", "2025-01-01", adj_close=0.0)])
    errs = [(i * 7 % 40) / 1000 for i in range(40)]
    b = bars([bar("A", x, adj_close=100.0 * (1 + e)) for x, e in zip(d, errs)] + [bar("A", "2025-01-01")])
    row = R.parity_metrics(a, b).first()
    got = np.abs(np.array([100.0 * (1 + e) for e in errs]) - 100.0) / 100.0
    assert row["overlap_rows"] == 40
    assert row["median_abs_pct_error"] == pytest.approx(float(np.median(got)), rel=1e-13)
    assert row["p95_abs_pct_error"] == pytest.approx(float(np.quantile(got, 0.95)), rel=1e-13)
    assert row["max_abs_pct_error"] == got.max()
    empty = R.parity_metrics(a, b.limit(0)).first()
    assert (empty["overlap_rows"], empty["median_abs_pct_error"]) == (0, None)


def test_evidence_kind(bars):
    d = "2024-01-01"
    a = bars([bar("A", d), bar("B", d, volume=1), bar("C", d, 10.0 + 1e-7), bar("D", d, 10.0 + 1e-9)])
    out = R.evidence_kind(a, bars([bar(s, d) for s in "ABCD"]))
    assert dict(rows_of(out, "security_id", "kind")) == {"A": "exact", "B": "volume_only", "C": "price_diff", "D": "exact"}
    assert dict(rows_of(R.evidence_summary(out))) == {"exact": 2, "volume_only": 1, "price_diff": 1}


def test_coverage_and_fallback(bars, spark):
    d = days("2020-01-01", 253)
    offer = lambda rows, p, n: bars(rows).withColumns({"provider": F.lit(p), "priority": F.lit(n)})
    first = offer([bar("A", x) for x in d[:252]] + [bar("B", x) for x in d[:251]] + [bar("C", d[0])], "ONE", 1)
    second = offer([bar("A", x) for x in d] + [bar("B", x) for x in d] + [bar("C", x, adj_close=0.0 if i < 2 else 1.0) for i, x in enumerate(d)], "TWO", 2)
    cov = {r["security_id"]: r for r in R.bar_coverage(second).collect()}
    assert (cov["C"]["rows"], cov["C"]["adjusted_close_rows"], cov["C"]["has_252_adjusted_close_bars"]) == (253, 251, False)
    assert tuple(R.coverage_fraction(R.bar_coverage(second)).first()) == (3, 2, 2 / 3)
    universe = spark.createDataFrame([(s,) for s in "ABCD"], "security_id string")
    assert rows_of(R.provider_fallback(universe, first.unionByName(second))) == [
        ("A", "ONE", 252), ("B", "TWO", 253), ("C", "UNRESOLVED", 0), ("D", "UNRESOLVED", 0),
    ]


def test_universe_symbols_and_sample(spark):
    rows = [(" aa", "N", None), ("AA", None, "n"), ("BB", "y", "N"), ("CC", "N", " TRUE "), (" ", "N", "N"), ("DD", "no", "0"), ("EE", "1", None)]
    symbols = R.universe_symbols(spark.createDataFrame(rows, "symbol string, is_etf string, test_issue string"))
    assert rows_of(symbols) == [("AA",), ("DD",)]
    many = spark.createDataFrame([(f"S{i}",) for i in range(50)], "symbol string")
    want = sorted((f"S{i}" for i in range(50)), key=lambda s: hashlib.sha256(f"seed|{s}".encode()).hexdigest())[:7]
    assert [r["symbol"] for r in R.hash_sample(many.repartition(3), 7, "seed").collect()] == want
    with pytest.raises(ValueError):
        R.hash_sample(many, 0, "seed")


def test_parity_leaves_nan_out(bars):
    nan = float("nan")
    a = bars([bar("A", d, 10.0, adj_close=v) for d, v in zip(days("2024-01-01", 4), (10.0, 10.0, nan, 10.0))])
    b = bars([bar("A", d, 10.0, adj_close=v) for d, v in zip(days("2024-01-01", 4), (10.0, 12.0, 10.0, nan))])
    row = R.parity_metrics(a, b).first()
    assert (row["overlap_rows"], row["max_abs_pct_error"]) == (3, 0.2)
