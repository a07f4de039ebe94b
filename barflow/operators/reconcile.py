"""Reconciliation of bars between providers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.functions.quantiles import exact_quantiles
from barflow.schemas import BAR_KEY, PRICES

COMPARED = ["open", "high", "low", "close", "volume"]

# Fixed values.
EVIDENCE_TOLERANCE = 1e-8
REQUIRED_BARS = 252


def provider_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bars of A against bars of B by (security, date), each unique by key.

    B's unsound bars are kept with ``row_class`` ``b_invalid`` and left out of
    the comparison, so the A bar of that date counts as only in A.
    """
    fields = [*COMPARED, "adj_close"]
    left = a.select(*BAR_KEY, *[F.col(c).cast("double").alias(f"a_{c}") for c in fields], F.lit(True).alias("in_a"))
    issues = X.qc_issues_no_adj()
    right = b.select(
        *BAR_KEY,
        *[F.col(c).cast("double").alias(f"b_{c}") for c in fields],
        X.joined(issues).alias("b_issues"),
    )
    j = left.join(right, BAR_KEY, "full_outer")
    in_a = F.col("in_a").isNotNull()
    observed = F.col("b_issues").isNotNull()
    b_ok = F.coalesce(F.col("b_issues") == "", F.lit(False))
    label = (
        F.when(in_a & b_ok, "common")
        .when(in_a & observed, "only_in_a_b_invalid")
        .when(in_a, "only_in_a")
        .when(b_ok, "only_in_b")
        .otherwise("b_invalid")
    )
    common = in_a & b_ok
    deltas = []
    for c in COMPARED:
        delta = F.col(f"a_{c}") - F.col(f"b_{c}")
        deltas.append(F.when(common, delta).alias(f"{c}_delta"))
        deltas.append(F.when(common & (F.col(f"b_{c}") != 0), delta / F.col(f"b_{c}")).alias(f"{c}_relative"))
    adj = F.when(
        common & X.is_finite("a_adj_close") & X.is_finite("b_adj_close"),
        F.col("a_adj_close") - F.col("b_adj_close"),
    )
    return j.select(*BAR_KEY, label.alias("row_class"), *deltas, adj.alias("adj_close_delta"), "b_issues")


def provider_compare_summary(compared: DataFrame) -> DataFrame:
    """Per security: date counts by class and the latest dates of either side."""
    k = F.col("row_class")
    in_a = k.isin("common", "only_in_a", "only_in_a_b_invalid")
    b_valid = k.isin("common", "only_in_b")
    b_seen = b_valid | k.isin("b_invalid", "only_in_a_b_invalid")
    last = lambda test: F.max(F.when(test, F.col("date")))
    return compared.groupBy("security_id").agg(
        F.count_if(k == "common").alias("common_dates"),
        F.count_if(k.isin("only_in_a", "only_in_a_b_invalid")).alias("dates_only_in_a"),
        F.count_if(k == "only_in_b").alias("dates_only_in_b"),
        F.count_if(k.isin("b_invalid", "only_in_a_b_invalid")).alias("b_invalid_dates"),
        last(in_a).alias("a_latest_date"),
        last(b_valid).alias("b_latest_valid_date"),
        last(b_seen).alias("b_latest_observed_date"),
    )


def parity_errors(canonical: DataFrame, other: DataFrame) -> DataFrame:
    """Absolute relative error of adjusted closes on shared (ticker, date) rows."""
    left = canonical.select("ticker", "date", "adj_close")
    right = other.select("ticker", "date", F.col("adj_close").alias("other_adj_close"))
    # NaN sorts above every number, so it has to be ruled out by name
    j = left.join(right, ["ticker", "date"]).filter((F.abs("adj_close") > 0) & ~F.isnan("adj_close"))
    return j.select(
        "ticker", "date", (F.abs(F.col("other_adj_close") - F.col("adj_close")) / F.abs("adj_close")).alias("err")
    )


def parity_metrics(canonical: DataFrame, other: DataFrame) -> DataFrame:
    """One row: overlap rows, median, 95th percentile and maximum of the error, all exact."""
    errors = parity_errors(canonical, other)
    usable = errors.filter(X.is_finite("err"))
    q = exact_quantiles(usable, "err", [0.5, 0.95])
    at = lambda p: F.max(F.when(F.col("probability") == p, F.col("quantile")))
    quantiles = q.agg(at(0.5).alias("median_abs_pct_error"), at(0.95).alias("p95_abs_pct_error"))
    facts = errors.agg(F.count("*").alias("overlap_rows"), F.max(F.when(~F.isnan("err"), F.col("err"))).alias("max_abs_pct_error"))
    both = quantiles.withColumn("f", facts.select(F.struct("*")).scalar())
    return both.select(
        "f.overlap_rows", "median_abs_pct_error", "p95_abs_pct_error", "f.max_abs_pct_error"
    )


def evidence_kind(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shared bars of two sources as ``exact``, ``volume_only`` or ``price_diff``."""
    left = a.select(*BAR_KEY, *[F.col(c).alias(f"a_{c}") for c in [*PRICES, "volume"]])
    right = b.select(*BAR_KEY, *[F.col(c).alias(f"b_{c}") for c in [*PRICES, "volume"]])
    same: Column = F.lit(True)
    for c in PRICES:
        same = same & (F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) < EVIDENCE_TOLERANCE)
    same = F.coalesce(same, F.lit(False))
    volume = F.col("a_volume") - F.col("b_volume")
    kind = F.when(same & (volume == 0), "exact").when(same, "volume_only").otherwise("price_diff")
    return left.join(right, BAR_KEY).select(*BAR_KEY, kind.alias("kind"), volume.alias("volume_diff"))


def evidence_summary(kinds: DataFrame) -> DataFrame:
    return kinds.groupBy("kind").agg(F.count("*").alias("bars"))


def bar_coverage(rows: DataFrame, keys: Sequence[str] = ("security_id",)) -> DataFrame:
    """Per key: rows, positive adjusted closes, their date span, and the 252-bar flag."""
    good = F.col("adj_close").isNotNull() & ~F.isnan("adj_close") & (F.col("adj_close") > 0)
    day = F.when(good, F.col("date"))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count_if(good).alias("adjusted_close_rows"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        (F.count_if(good) >= REQUIRED_BARS).alias("has_252_adjusted_close_bars"),
    )


def coverage_fraction(coverage: DataFrame) -> DataFrame:
    """One row: securities, covered ones and the fraction (NULL for none)."""
    out = coverage.agg(
        F.count("*").alias("securities"), F.count_if("has_252_adjusted_close_bars").alias("covered")
    )
    return out.withColumn("coverage_fraction", X.safe_ratio("covered", "securities"))


def provider_fallback(universe: DataFrame, offers: DataFrame) -> DataFrame:
    """Per security the first provider, by ``priority``, with enough adjusted closes.

    ``offers``: bar rows with ``provider`` and ``priority``.
    """
    cov = bar_coverage(offers, ["security_id", "provider", "priority"])
    best = (
        cov.filter("has_252_adjusted_close_bars")
        .groupBy("security_id")
        .agg(
            F.min_by("provider", "priority").alias("selected_provider"),
            F.min_by("adjusted_close_rows", "priority").alias("adjusted_close_rows"),
        )
    )
    return universe.select("security_id").join(best, "security_id", "left").select(
        "security_id",
        F.coalesce("selected_provider", F.lit("UNRESOLVED")).alias("selected_provider"),
        F.coalesce("adjusted_close_rows", F.lit(0)).alias("adjusted_close_rows"),
    )


def universe_symbols(directory: DataFrame) -> DataFrame:
    """Distinct symbols that are neither funds nor test issues."""
    flag = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))).isin("Y", "YES", "TRUE", "1")
    symbol = F.upper(F.trim("symbol"))
    return (
        directory.filter((F.coalesce(symbol, F.lit("")) != "") & ~flag("is_etf") & ~flag("test_issue"))
        .select(symbol.alias("symbol"))
        .distinct()
    )


def hash_sample(symbols: DataFrame, k: int, seed: str, column: str = "symbol") -> DataFrame:
    """The ``k`` symbols with the smallest SHA-256 of ``seed|symbol``: stable and order-free."""
    if k < 1:
        raise ValueError("k must be at least 1")
    rank = F.sha2(F.concat_ws("|", F.lit(seed), F.col(column)), 256)
    return symbols.withColumn("sample_rank", rank).orderBy("sample_rank").limit(k)


