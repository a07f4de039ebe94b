import math
import random

import numpy as np
import pytest
from conftest import bar, rows_of
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.functions.keep import keep_first, keep_last
from barflow.functions.quantiles import exact_quantiles

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"close": None}, ["missing_or_nonnumeric"]),
        ({"volume": None}, ["missing_or_nonnumeric"]),
        ({"open": NAN}, ["nonfinite"]),
        ({"high": INF}, ["nonfinite"]),
        ({"high": -INF, "close": None}, ["missing_or_nonnumeric"]),
        ({"low": 0.0}, ["nonpositive_price"]),
        ({"adj_close": -1.0}, ["nonpositive_price"]),
        ({"volume": -1}, ["negative_volume"]),
        ({"high": 9.5}, ["high_below_open_close_or_low"]),
        ({"low": 10.5}, ["low_above_open_close_or_high"]),
        ({"high": 8.0, "volume": -5}, ["negative_volume", "high_below_open_close_or_low", "low_above_open_close_or_high"]),
    ],
)
def test_qc_rules(bars, changes, expected):
    got = bars([bar("A", "2024-01-02", **changes)]).select(X.qc_issues().alias("i")).first()["i"]
    assert got == expected


def test_other_vocabularies(bars):
    df = bars([bar("A", "2024-01-02", high=9.5, adj_close=None)])
    row = df.select(X.qc_issues_no_adj().alias("a"), X.qc_issues_short().alias("b"), X.qc_range().alias("c")).first()
    assert row["a"] == ["high_below_open_close_or_low"]
    assert row["b"] == ["high_below_range"]
    assert row["c"] == ["nonfinite_or_missing"]
    whole = bars([bar("A", "2024-01-02", high=9.5)]).select(X.qc_range().alias("c")).first()
    assert whole["c"] == ["open_above_high", "close_outside_range"]


def test_is_close_follows_numpy(spark):
    values = [0.0, 1.0, 1.0 + 1e-9, 1.0 + 1e-6, -1.0, NAN, INF, -INF, 1e300]
    pairs = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [r[0] for r in df.select(X.is_close("a", "b", 1e-7, 1e-9)).collect()]
    assert got == [bool(np.isclose(a, b, rtol=1e-7, atol=1e-9)) for a, b in pairs]
    null = spark.createDataFrame([(None, 1.0)], "a double, b double").select(X.is_close("a", "b", 1, 1)).first()
    assert null[0] is False


@pytest.mark.parametrize(
    "utc, expected",
    [
        ("2024-01-10 22:29:59", "2024-01-09"),  # 17:29:59 in New York
        ("2024-01-10 22:30:00", "2024-01-10"),
        ("2024-07-10 21:29:59", "2024-07-09"),  # daylight saving: 17:29:59
        ("2024-07-10 21:30:00", "2024-07-10"),
        ("2024-03-10 21:30:00", "2024-03-10"),  # the day the clocks change
        ("2024-11-03 22:29:00", "2024-11-02"),
        ("2024-01-11 03:00:00", "2024-01-10"),  # still the evening before
    ],
)
def test_finalized_through(spark, utc, expected):
    df = spark.createDataFrame([(utc,)], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    assert str(df.select(X.finalized_through("ts")).first()[0]) == expected


def test_weekend_and_fixed_hour_cutoffs(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-06",), ("2024-01-07",)], "d string").select(
        F.col("d").cast("date").alias("d")
    )
    assert {str(r[0]) for r in df.select(X.weekend_to_friday("d")).collect()} == {"2024-01-05"}
    ts = spark.createDataFrame([("2024-01-05 21:59:59",), ("2024-01-05 22:00:00",)], "t string")
    got = [str(r[0]) for r in ts.select(X.utc_hour_cutoff(F.col("t").cast("timestamp"))).collect()]
    assert got == ["2024-01-04", "2024-01-05"]


def test_round_cents_equals_python_round(spark):
    rng = random.Random(7)
    values = [2.675, 1.005, 0.125, 0.375, 2.5, 1.115, 8.345, 100.0, 0.005, 0.015, 1234567.885]
    values += [rng.randrange(1, 10**7) / 200 for _ in range(2000)]
    values += [rng.uniform(0.01, 5e5) for _ in range(2000)]
    values += [math.nextafter(v, INF) for v in values[:200]] + [math.nextafter(v, 0) for v in values[:200]]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", X.round_cents("v").alias("r")).collect()
    assert [(r["v"], r["r"]) for r in got if r["r"] != round(r["v"], 2)] == []


def test_trend_class_is_strict(spark):
    rows = [(5.0, 4.0, 3.0, 2.0, 1.0), (1.0, 2.0, 3.0, 4.0, 5.0), (5.0, 4.0, 4.0, 2.0, 1.0), (5.0, 5.0, 3.0, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "last_price double, ema20 double, ema50 double, ema150 double, ema200 double")
    assert [r[0] for r in df.select(X.trend_class()).collect()] == ["STACKED_UP", "STACKED_DOWN", "MIXED", "MIXED"]


def test_leading_date(spark):
    texts = ["2024-01-02T10:00:00Z", " 2024-01-02", "20240102", "2024-13-01", "", None, "n/a", "2024-1-2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [None if r[0] is None else str(r[0]) for r in df.select(X.leading_date("t")).collect()]
    assert got == ["2024-01-02", "2024-01-02", "2024-01-02", None, None, None, None, None]


def test_keep_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 5, "z"), ("a", 0, "w")], "k string, o int, v string")
    assert rows_of(keep_last(df, ["k"], ["o"])) == [("a", 2, None), ("b", 5, "z")]
    assert rows_of(keep_first(df, ["k"], ["o"])) == [("a", 0, "w"), ("b", 5, "z")]


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(3)
    # a third of the values are one and the same
    values = [0.0] * 300 + [rng.expovariate(5) for _ in range(500)] + [rng.choice([0.25, 0.5, 3.0]) for _ in range(101)]
    df = spark.createDataFrame([("g" if i % 4 else "h", v) for i, v in enumerate(values)], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {r["probability"]: r["quantile"] for r in exact_quantiles(df, "v", probs).collect()}
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in probs}, rel=1e-14)
    per = {(r["g"], r["probability"]): r["quantile"] for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    for g in "gh":
        own = [v for i, v in enumerate(values) if ("g" if i % 4 else "h") == g]
        assert per[(g, 0.5)] == pytest.approx(float(np.quantile(own, 0.5)), rel=1e-14)
    one = exact_quantiles(spark.createDataFrame([(2.5,)], "v double"), "v", [0.5, 0.95]).collect()
    assert {r["quantile"] for r in one} == {2.5}


def test_is_sound_is_having_no_issue(spark, bars):
    odd = [None, float("nan"), float("inf"), -float("inf"), -1.0, 0.0, 5.0, 50.0]
    rows = [bar("A", "2024-01-02", **{c: v}) for c in ("open", "high", "low", "close", "adj_close") for v in odd]
    rows += [bar("A", "2024-01-02", volume=v) for v in (None, -1, 0, 7)]
    rows += [bar("A", "2024-01-02", **{c: None, "volume": -1}) for c in ("open", "adj_close")]
    got = bars(rows).select(X.is_sound().alias("sound"), (F.size(X.qc_issues()) == 0).alias("named")).collect()
    assert [r["sound"] for r in got] == [r["named"] for r in got]
    assert {r["sound"] for r in got} == {True, False}
