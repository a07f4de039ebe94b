import pytest
from conftest import bar, days, rows_of

from barflow.operators.signals import fold_signals, signal_outcomes

SCHEMA = (
    "signal_id string, status string, strategy string, days_in_status int, entry_price double, stop_loss double, take_profit double,"
    " bars array<struct<open:double,high:double,low:double,close:double>>"
)


def outcome(spark, status, strategy, days_in, bars):
    row = ("s", status, strategy, days_in, 100.0, 90.0, 120.0, bars)
    r = fold_signals(spark.createDataFrame([row], SCHEMA)).first()
    return r["status"], r["days_in_status"], r["entry_price_actual"], r["exit_price"], r["missed_reason"]


QUIET = (95.0, 99.0, 94.0, 96.0)
HELD = (105.0, 110.0, 101.0, 108.004)


@pytest.mark.parametrize(
    "status, strategy, days_in, bars, expected",
    [
        ("pending", "pullback", 0, [(100, 103, 89, 95)], ("sl_hit", 0, 100.0, 90.0, None)),
        ("pending", "breakout", 0, [(101, 104, 95, 103)], ("entered", 0, 101.0, None, None)),
        ("entered", "breakout", 0, [(85, 88, 80, 82)], ("sl_hit", 1, None, 85.0, None)),
        ("entered", "breakout", 0, [(105, 121, 100, 118)], ("tp_hit", 1, None, 120.0, None)),
        ("entered", "breakout", 9, [(106, 109, 101, 108)], ("closed_timeout", 10, None, 108.0, None)),
        ("entered", "breakout", 0, [(105, 125, 89, 100)], ("sl_hit", 1, None, 90.0, None)),  # stop wins
        ("pending", "breakout", 0, [QUIET] * 2, ("pending", 2, None, None, None)),
        ("pending", "breakout", 0, [QUIET] * 3, ("missed", 3, None, None, "expired")),
        ("pending", "breakout", 0, [(95, 96, 89, 90)], ("missed", 1, None, None, "sl_hit_before_entry")),
        ("pending", "breakout", 0, [QUIET, QUIET, (101.118, 104, 95, 103)] + [HELD] * 12, ("closed_timeout", 10, 101.12, 108.0, None)),
        ("pending", "pullback", 0, [(97, 99, 96, 98), (85, 86, 80, 81)], ("sl_hit", 1, 97.0, 85.0, None)),
        ("pending", "pullback", 0, [], ("pending", 0, None, None, None)),
    ],
)
def test_life_cycle(spark, status, strategy, days_in, bars, expected):
    bars = [tuple(float(x) for x in b) for b in bars]
    assert outcome(spark, status, strategy, days_in, bars) == expected


def test_bars_after_the_signal_date_are_used_in_order(bars, spark):
    d = days("2024-01-01", 20)
    history = bars([bar("A", x, 95.0, high=96.0, low=94.0) for x in d[:3]] + [bar("A", d[4], 101.0, high=104.0, low=95.0)] + [bar("A", d[5], 118.0, high=121.0)])
    schema = "signal_id string, security_id string, signal_date date, strategy string, status string, days_in_status int, entry_price double, stop_loss double, take_profit double"
    make = lambda i, when: (i, "A", when, "breakout", "pending", 0, 100.0, 90.0, 120.0)
    # the second signal falls on a day without a bar, the last one after all bars
    signals = spark.createDataFrame([make("x", d[2]), make("y", d[3]), make("x2", d[2]), make("z", d[9])], schema)
    assert rows_of(signal_outcomes(signals, history), "signal_id", "status", "exit_price") == [
        ("x", "tp_hit", 120.0), ("x2", "tp_hit", 120.0), ("y", "tp_hit", 120.0), ("z", "pending", None),
    ]
