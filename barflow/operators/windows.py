"""Rolling windows, readiness, relative strength and history gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.operators.normalize import ADJUST_ISSUES, adjusted_ohlc, monotonic_check
from barflow.schemas import BAR_COLUMNS, require_columns


def rolling_tail(bars: DataFrame, n: int = 300, order_col: str | None = None) -> DataFrame:
    """The bars of the last ``n`` dates per security, one per date.

    A repeated date keeps its row with the greatest ``order_col`` (without one,
    the greatest values). Spark plans a group limit below the shuffle, so each
    map task sends the rows of at most ``n`` dates of a security; picking one row
    per date needs no further shuffle.
    """
    latest = Window.partitionBy("security_id").orderBy(F.col("date").desc())
    order = [order_col] if order_col else [c for c in BAR_COLUMNS if c in bars.columns and c not in ("security_id", "date")]
    per_date = Window.partitionBy("security_id", "date").orderBy(*[F.col(c).desc() for c in order])
    tail = bars.withColumn("__rank", F.dense_rank().over(latest)).filter(F.col("__rank") <= n)
    return tail.withColumn("__rn", F.row_number().over(per_date)).filter("__rn = 1").drop("__rank", "__rn")


def readiness(
    members: DataFrame,
    bars: DataFrame,
    reviewed: DataFrame | None = None,
    n: int = 300,
    minimum: int = 250,
) -> DataFrame:
    """Per eligible member: bar counts, rolling dates and readiness status.

    ``members`` are the eligible ones. The rolling window is the last ``n`` bars,
    so its size is ``least(count, n)``; dates are gathered as a set, which the
    calendar bounds, and no bar is sorted.
    """
    if not 1 <= minimum <= n:
        raise ValueError("minimum must lie between 1 and n")
    # one entry per calendar date: the n-th date from the end starts the window
    dates = F.sort_array(F.collect_set("date"), asc=False)
    counts = bars.groupBy("security_id").agg(dates.alias("__dates")).select(
        "security_id",
        "__dates",
        F.size("__dates").cast("long").alias("available_bars"),
        F.try_element_at("__dates", F.lit(1)).alias("last_date"),
    )
    rolling = F.least(F.col("available_bars"), F.lit(n))
    facts = counts.select(
        "security_id",
        "available_bars",
        rolling.alias("rolling_bars"),
        F.try_element_at("__dates", rolling.cast("int")).alias("first_rolling_date"),
        "last_date",
    )
    return readiness_of(members, facts, reviewed, minimum)


def readiness_of(members: DataFrame, facts: DataFrame, reviewed: DataFrame | None, minimum: int) -> DataFrame:
    """Members with their facts (counts and dates of the window) and status."""
    rows = members.select("security_id", "ticker").join(facts, "security_id", "left")
    if reviewed is not None:
        rows = rows.join(
            reviewed.select("security_id").distinct().withColumn("reviewed", F.lit(True)),
            "security_id",
            "left",
        )
    else:
        rows = rows.withColumn("reviewed", F.lit(None).cast("boolean"))
    status = (
        F.when(F.col("available_bars").isNull() & F.coalesce("reviewed", F.lit(False)), "reviewed_no_retry")
        .when(F.col("available_bars").isNull(), "unavailable")
        .when(F.col("rolling_bars") >= minimum, "ready")
        .otherwise("insufficient")
    )
    return rows.select(
        "security_id",
        "ticker",
        F.coalesce("available_bars", F.lit(0)).alias("available_bars"),
        F.coalesce("rolling_bars", F.lit(0)).alias("rolling_bars"),
        "first_rolling_date",
        "last_date",
        status.alias("status"),
    )


def readiness_summary(detail: DataFrame) -> DataFrame:
    """One row of the counts that describe a readiness table."""
    s = F.col("status")
    return detail.agg(
        F.count("*").alias("confirmed_compliant"),
        F.count_if(s.isin("ready", "insufficient")).alias("included_in_rolling"),
        F.count_if(s == "ready").alias("ready"),
        F.count_if(s == "insufficient").alias("insufficient_history"),
        F.count_if(s == "unavailable").alias("data_unavailable"),
        F.count_if(s == "reviewed_no_retry").alias("reviewed_no_retry"),
        F.coalesce(F.sum("rolling_bars"), F.lit(0)).alias("rolling_rows"),
    )


def common_calendar(bars: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Bars joined to the benchmark close of the same date."""
    other = benchmark.select("date", F.col("close").alias("close_benchmark"))
    return bars.withColumnRenamed("close", "close_stock").join(other, "date")


def rs20_series(aligned: DataFrame, lag: int = 20) -> DataFrame:
    """Relative strength of every shared bar; NULL for a security's first ``lag`` bars."""
    order = Window.partitionBy("security_id").orderBy("date")
    stock = F.col("close_stock") / F.lag("close_stock", lag).over(order) - 1
    bench = F.col("close_benchmark") / F.lag("close_benchmark", lag).over(order) - 1
    return aligned.select(
        "security_id",
        "date",
        ((stock - bench) * 100).alias("rs20"),
        F.row_number().over(order).alias("shared_bars"),
    )


def rs20(aligned: DataFrame, lag: int = 20) -> DataFrame:
    """Latest relative strength per security, with the count of shared bars.

    The latest bar and the one ``lag`` bars earlier are the ends of the last
    ``lag + 1`` shared bars, so only that tail is kept after the shuffle.
    """
    latest = Window.partitionBy("security_id").orderBy(F.col("date").desc())
    tail = (
        aligned.select("security_id", "date", "close_stock", "close_benchmark")
        .withColumn("rn", F.row_number().over(latest))
        .filter(F.col("rn") <= lag + 1)
    )
    at = lambda c, rn: F.max(F.when(F.col("rn") == rn, F.col(c)))
    ends = tail.groupBy("security_id").agg(
        F.count("*").alias("tail_bars"),
        F.max("date").alias("date"),
        at("close_stock", 1).alias("s1"),
        at("close_stock", lag + 1).alias("s0"),
        at("close_benchmark", 1).alias("b1"),
        at("close_benchmark", lag + 1).alias("b0"),
    )
    value = ((F.col("s1") / F.col("s0") - 1) - (F.col("b1") / F.col("b0") - 1)) * 100
    enough = F.col("tail_bars") > lag
    return ends.select(
        "security_id",
        "date",
        F.when(enough, value).alias("rs20"),
        F.when(enough, F.round(value, 2)).alias("rs20_rounded"),
        F.when(enough, "ok").otherwise("fewer_than_21_shared_bars").alias("outcome"),
    )


def history_gate(
    bars: DataFrame,
    benchmark: DataFrame,
    expected: DataFrame,
    order_col: str | None = None,
    minimum_shared: int = 21,
) -> DataFrame:
    """Full-history gate per expected (security_id, ticker): ``passed`` or the first failure.

    Order of the checks: identity, dates, QC, adjusted O/H/L/C, shared calendar.
    """
    require_columns(bars, BAR_COLUMNS, "history")
    want = expected.select("security_id", F.col("ticker").alias("expected_ticker"))
    rows = bars.join(want, "security_id")
    qc = X.is_sound()
    base = rows.withColumn("bad_qc", ~qc)
    adjusted = adjusted_ohlc(base)
    # issues as numbers in report order: the smallest wins, and hash aggregation is kept
    names = F.array(*[F.lit(n) for n in ADJUST_ISSUES])
    adjusted = adjusted.withColumn(
        "issue_no", F.when(F.col("adjust_issue").isNotNull(), F.array_position(names, F.col("adjust_issue")))
    )
    # first reduce to one row per (security, date): repeated dates show as n > 1
    per_date = adjusted.groupBy("security_id", "date").agg(
        F.count("*").alias("n"),
        F.bool_or(~F.col("ticker").eqNullSafe(F.col("expected_ticker"))).alias("alien"),
        F.bool_or("bad_qc").alias("bad_qc"),
        F.min("issue_no").alias("issue_no"),
        F.min("adjustment_factor").alias("fmin"),
        F.max("adjustment_factor").alias("fmax"),
        F.min("close").alias("close"),
    )
    shared = benchmark.select("date", F.col("close").alias("close_benchmark"))
    joined = per_date.join(shared, "date", "left")
    facts = joined.groupBy("security_id").agg(
        F.sum("n").alias("history_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.bool_or("alien").alias("alien"),
        F.bool_or((F.col("n") > 1) | F.col("date").isNull()).alias("bad_dates"),
        F.bool_or("bad_qc").alias("bad_qc"),
        F.min("issue_no").alias("issue_no"),
        F.count("close_benchmark").alias("shared_rows"),
        F.max(F.when(F.col("close_benchmark").isNotNull(), F.col("date"))).alias("shared_last_date"),
        F.min("fmin").alias("factor_min"),
        F.max("fmax").alias("factor_max"),
    )
    if order_col is not None:
        order = monotonic_check(bars, ["security_id"], "date", order_col)
        facts = facts.join(order.select("security_id", "strictly_increasing"), "security_id")
        facts = facts.withColumn("bad_dates", F.col("bad_dates") | ~F.col("strictly_increasing"))
    error = (
        F.when(F.col("history_rows").isNull(), "no_history")
        .when(F.col("alien"), "identity_mismatch")
        .when(F.col("bad_dates"), "invalid_duplicate_or_unordered_dates")
        .when(F.col("bad_qc"), "qc_rejected")
        .when(F.col("issue_no").isNotNull(), F.try_element_at(names, F.col("issue_no").cast("int")))
        .when(F.col("shared_rows") < minimum_shared, "fewer_than_21_shared_bars")
    )
    return (
        want.join(facts, "security_id", "left")
        .withColumn("error", error)
        .select(
            "security_id",
            F.col("expected_ticker").alias("ticker"),
            F.when(F.col("error").isNull(), "passed").otherwise("failed").alias("status"),
            "error",
            F.coalesce("history_rows", F.lit(0)).alias("history_rows"),
            "first_date",
            "last_date",
            F.coalesce("shared_rows", F.lit(0)).alias("shared_rows"),
            "shared_last_date",
            "factor_min",
            "factor_max",
        )
    )
