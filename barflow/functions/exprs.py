"""Column expressions shared by the operators. No Python UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from barflow.schemas import BAR_VALUES

INF = float("inf")

# Minutes from local midnight to the end of the safety buffer
# (16:00 New York close plus 90 minutes).
EXCHANGE_ZONE = "America/New_York"
FINAL_MINUTE = 16 * 60 + 90


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_finite(value: Column | str) -> Column:
    """True for a real number; NULL, NaN and infinities give false."""
    c = col(value)
    return F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(INF)), F.lit(False))


def is_close(a: Column | str, b: Column | str, rtol: float, atol: float) -> Column:
    """``|a - b| <= atol + rtol * |b|``; ``b`` is the side the tolerance scales with.

    Spark orders NaN above every number, so NaN and infinite sides are settled
    before the comparison. NULL on either side gives false.
    """
    a, b = col(a), col(b)
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.coalesce(
        F.when(F.isnan(a) | F.isnan(b), F.lit(False))
        .when((F.abs(a) == F.lit(INF)) | (F.abs(b) == F.lit(INF)), a == b)
        .otherwise(near),
        F.lit(False),
    )


def _rules(pairs: Sequence[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in pairs]))


def _unusable(fields: Sequence[str]) -> tuple[Column, Column]:
    """Is a field missing, and is one no finite number?"""
    values = [F.col(f).cast("double") for f in fields]
    absent = values[0].isNull()
    broken = ~is_finite(values[0])
    for value in values[1:]:
        absent = absent | value.isNull()
        broken = broken | ~is_finite(value)
    return absent, broken


def _gated_rules(fields: Sequence[str], missing: str, nonfinite: str, rules: Column) -> Column:
    """Missing wins, then nonfinite, and only then are the range rules tested."""
    absent, broken = _unusable(fields)
    return (
        F.when(absent, F.array(F.lit(missing)))
        .when(broken, F.array(F.lit(nonfinite)))
        .otherwise(rules)
    )


def _bar_rules(fields: Sequence[str], high_rule: str, low_rule: str) -> list[tuple[str, Column]]:
    prices = [F.col(f) for f in fields if f != "volume"]
    nonpositive = prices[0] <= 0
    for price in prices[1:]:
        nonpositive = nonpositive | (price <= 0)
    o, h, lo, c = (F.col(n) for n in ("open", "high", "low", "close"))
    pairs = [("nonpositive_price", nonpositive)]
    if "volume" in fields:
        pairs.append(("negative_volume", F.col("volume") < 0))
    pairs += [
        (high_rule, h < F.greatest(o, c, lo)),
        (low_rule, lo > F.least(o, c, h)),
    ]
    return pairs


def qc_issues(
    fields: Sequence[str] = tuple(BAR_VALUES),
    high_rule: str = "high_below_open_close_or_low",
    low_rule: str = "low_above_open_close_or_high",
) -> Column:
    """Rule names a bar breaks, as ``array<string>``; empty when it is sound."""
    rules = _rules(_bar_rules(fields, high_rule, low_rule))
    return _gated_rules(fields, "missing_or_nonnumeric", "nonfinite", rules)


PROVIDER_FIELDS = ("open", "high", "low", "close", "volume")


def qc_issues_no_adj() -> Column:
    """The same rules for providers that carry no adjusted close."""
    return qc_issues(PROVIDER_FIELDS)


def qc_issues_short() -> Column:
    """No adjusted close, short names for the two range rules."""
    return qc_issues(PROVIDER_FIELDS, "high_below_range", "low_above_range")


def qc_range() -> Column:
    """Range-only vocabulary: which of open and close leaves [low, high]."""
    o, h, lo, c = (F.col(n) for n in ("open", "high", "low", "close"))
    rules = _rules(
        [
            ("open_above_high", o > h),
            ("open_below_low", o < lo),
            ("close_outside_range", (c > h) | (c < lo)),
        ]
    )
    return _gated_rules(BAR_VALUES, "nonfinite_or_missing", "nonfinite_or_missing", rules)


def is_sound(issues: Column | None = None) -> Column:
    """Does a bar break no rule? Without ``issues`` the rules are asked one after the other and no names are gathered."""
    if issues is not None:
        return F.size(issues) == 0
    absent, broken = _unusable(BAR_VALUES)
    flawed = absent | broken
    for _, test in _bar_rules(BAR_VALUES, "high", "low"):
        flawed = flawed | test
    return ~flawed


def finalized_through(ts: Column | str) -> Column:
    """Latest session date that is safely final at a UTC timestamp."""
    local = F.from_utc_timestamp(col(ts), EXCHANGE_ZONE)
    return F.to_date(local - F.expr(f"INTERVAL {FINAL_MINUTE} MINUTES"))


def weekend_to_friday(day: Column | str) -> Column:
    """Saturday and Sunday fall back to the Friday before."""
    d = col(day)
    weekday = F.weekday(d)
    return F.when(weekday == 5, F.date_sub(d, 1)).when(weekday == 6, F.date_sub(d, 2)).otherwise(d)


def utc_hour_cutoff(ts: Column | str, hour: int = 22) -> Column:
    """Last date whose bar may be taken under a fixed UTC hour rule."""
    t = col(ts)
    day = F.to_date(t)
    return F.when(F.hour(t) >= hour, day).otherwise(F.date_sub(day, 1))


def trend_class(
    price: Column | str = "last_price", emas: Sequence[str] = ("ema20", "ema50", "ema150", "ema200")
) -> Column:
    chain = [col(price), *[F.col(e) for e in emas]]
    up = down = F.lit(True)
    for left, right in zip(chain, chain[1:]):
        up = up & (left > right)
        down = down & (left < right)
    return F.when(up, F.lit("STACKED_UP")).when(down, F.lit("STACKED_DOWN")).otherwise(F.lit("MIXED"))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives NULL, not an ANSI failure, for a zero denominator."""
    return F.try_divide(col(numerator), col(denominator))


def leading_date(text: Column | str) -> Column:
    """The ISO date in the first ten characters, or NULL when it does not parse."""
    head = F.substring(F.trim(col(text)), 1, 10)
    return F.coalesce(F.try_to_date(head, "yyyy-MM-dd"), F.try_to_date(head, "yyyyMMdd"))


def round_cents(value: Column | str) -> Column:
    """Round to two places by the exact binary value, ties to even.

    Spark's ``round`` works on the shortest decimal text, which turns 2.675 (held
    as slightly less) into 2.68. Here ``200 * value`` is formed with its exact
    rounding error (Dekker's product), so its distance to the half-way point
    ``2k + 1`` has the true sign.
    """
    x = col(value)
    p = x * 200.0
    big = x * 134217729.0
    high = big - (big - x)
    low = x - high
    err = (high * 200.0 - p) + low * 200.0
    k = F.floor(p / 2.0).cast("double")
    off = (p - (k * 2.0 + 1.0)) + err
    up = (off > 0) | ((off == 0) & (k % 2.0 != 0))
    return F.when(up, k + 1.0).otherwise(k) / 100.0


def joined(items: Column) -> Column:
    return F.array_join(items, "|")
