"""Split facts, point-in-time factors, identity lineage and provider symbols."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.functions.folds import product_fold

# Tolerance between two statements of the same split.
FACTOR_TOLERANCE = 1e-12

# Open interval ends stand for the calendar's ends.
FIRST_DAY = "0001-01-01"
LAST_DAY = "9999-12-31"

# Lifecycle statuses.
BLOCKING_STATUSES = ("VERIFIED_TERMINATED_PUBLIC_LISTING", "VERIFIED_NONTRADABLE_PRIMARY_EXCHANGE")
TICKER_CHANGE_STATUS = "VERIFIED_TICKER_CHANGE_SAME_SECURITY"


def split_extract(rows: DataFrame, factor_col: str = "split_factor", adjustments: bool = False) -> DataFrame:
    """Source rows with ``event_class``: ``event``, ``none`` (factor 1) or the error.

    With ``adjustments`` the column is one of a price table, where 0 or nothing
    means no split on that day. A table without the column is a gap in the
    acquisition, not an absence of splits: ``missing_split_column``.
    """
    if factor_col not in rows.columns:
        return rows.withColumns({"event_class": F.lit("missing_split_column"), "factor": F.lit(None).cast("double")})
    raw = F.col(factor_col)
    number = raw.try_cast("double")
    if adjustments:
        quiet = raw.isNull() | F.isnan(number) | (number == 0)
    else:
        quiet = F.lit(False)
    label = (
        F.when(quiet, "none")
        .when(raw.isNull(), "null_split_factor")
        .when(number.isNull(), "non_numeric_split_factor")
        .when(~X.is_finite(number) | (number <= 0), "invalid_split_factor")
        .when(number == 1.0, "none")
        .otherwise("event")
    )
    return rows.withColumn("event_class", label).withColumn("factor", number)


def split_events(rows: DataFrame, factor_col: str = "split_factor", adjustments: bool = False) -> DataFrame:
    """(security_id, effective_date, split_factor, provider_ticker) of the event rows."""
    return (
        split_extract(rows, factor_col, adjustments)
        .filter(F.col("event_class") == "event")
        .select(
            "security_id",
            F.col("date").alias("effective_date"),
            F.col("factor").alias("split_factor"),
            "provider_ticker",
        )
    )


def split_event_issues(events: DataFrame) -> DataFrame:
    """Events that lack an identity or whose factor is no split."""
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    factor = F.col("split_factor")
    sound = X.is_finite(factor) & (factor > 0) & (factor != 1)
    issue = F.when(blank("security_id") | blank("provider_ticker"), "identity_required").when(
        ~sound, "invalid_split_factor"
    )
    return events.withColumn("issue", issue).filter(F.col("issue").isNotNull())


def split_dedupe(events: DataFrame) -> DataFrame:
    """One row per (security, effective date); ``conflict`` when factors disagree."""
    return (
        events.groupBy("security_id", "effective_date")
        .agg(
            F.min("split_factor").alias("split_factor"),
            F.max("split_factor").alias("max_factor"),
            F.min("provider_ticker").alias("provider_ticker"),
            F.count("*").alias("statements"),
        )
        .withColumn("conflict", (F.col("max_factor") - F.col("split_factor")) > F.lit(FACTOR_TOLERANCE))
    )


def split_factor(bars: DataFrame, events: DataFrame, as_of: date) -> DataFrame:
    """Bars with the product of factors effective after the bar and up to ``as_of``.

    ``events`` are unique per (security, effective date). They are gathered per
    security into one array in effective-date order (bounded by the calendar), so
    a bar meets one row of the join, not one row per event.
    """
    ordered = F.sort_array(F.collect_list(F.struct("effective_date", "split_factor")))
    per_id = (
        events.filter(F.col("effective_date") <= F.lit(as_of))
        .groupBy("security_id")
        .agg(ordered.alias("events"))
    )
    later = F.filter("events", lambda e: e.getField("effective_date") > F.col("date"))
    factor = product_fold(later.getField("split_factor"))
    return (
        bars.join(per_id, "security_id", "left")
        .withColumn("factor", factor)
        .drop("events")
        .withColumn("normalized_close", F.col("close") / F.col("factor"))
        .withColumn("normalized_volume", F.col("volume") * F.col("factor"))
    )


def split_stats(events: DataFrame, requested: DataFrame, acquired: DataFrame) -> DataFrame:
    """One row: event rows, securities, directions, and the acquisition gap.

    ``requested`` and ``acquired`` are ticker sets; repeated statements of one
    (security, effective date) count once.
    """
    unique = events.groupBy("security_id", "effective_date").agg(F.max("split_factor").alias("f"))
    per_id = unique.groupBy("security_id").agg(
        F.count("*").alias("events"),
        F.count_if(F.col("f") > 1).alias("forward"),
        F.count_if((F.col("f") > 0) & (F.col("f") < 1)).alias("reverse"),
    )
    zero = F.lit(0)
    facts = per_id.agg(
        F.coalesce(F.sum("events"), zero).alias("event_rows"),
        F.count("*").alias("securities"),
        F.coalesce(F.sum("forward"), zero).alias("forward_events"),
        F.coalesce(F.sum("reverse"), zero).alias("reverse_events"),
    )
    asked = requested.select("ticker").distinct()
    wanted = asked.agg(F.count("*")).scalar()
    gaps = asked.join(acquired.select("ticker"), "ticker", "left_anti").agg(F.count("*")).scalar()
    counted = facts.withColumn("tickers", wanted).withColumn("gap_count", gaps)
    return counted.withColumn("gap_rate", F.round(X.safe_ratio("gap_count", "tickers"), 6))


def split_crosscheck(expected: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Expected split facts against two providers, each unique per (security, date)."""
    key = ["security_id", "effective_date"]
    named = lambda df, name: df.select(*key, F.col("split_factor").alias(name))
    j = (
        named(expected, "expected_factor")
        .join(named(first, "first_factor"), key, "full_outer")
        .join(named(second, "second_factor"), key, "full_outer")
    )
    same = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) <= FACTOR_TOLERANCE, F.lit(False))
    match = same("first_factor", "second_factor")
    agreed = same("first_factor", "expected_factor") & same("second_factor", "expected_factor") & match
    return j.select(
        *key,
        "expected_factor",
        "first_factor",
        "second_factor",
        match.alias("cross_provider_match"),
        F.when(F.col("expected_factor").isNull(), "unexpected")
        .when(agreed, "PASS")
        .otherwise("FAIL")
        .alias("status"),
    )


def _alias_key() -> list[Column]:
    return [
        F.lower(F.trim("provider")).alias("provider"),
        F.upper(F.trim("provider_ticker")).alias("provider_ticker"),
    ]


def _intervals(aliases: DataFrame) -> DataFrame:
    """Aliases with both ends closed and each security's overlapping intervals merged."""
    rows = (
        aliases.select(
            *_alias_key(),
            "security_id",
            F.coalesce("valid_from", F.lit(FIRST_DAY).cast("date")).alias("start"),
            F.coalesce("valid_to", F.lit(LAST_DAY).cast("date")).alias("end"),
        )
        .filter(F.col("start") <= F.col("end"))
        .groupBy("provider", "provider_ticker", "security_id", "start")
        .agg(F.max("end").alias("end"))
    )
    before = (
        Window.partitionBy("provider", "provider_ticker", "security_id")
        .orderBy("start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = rows.withColumn(
        "opens", F.coalesce((F.max("end").over(before) < F.col("start")).cast("int"), F.lit(1))
    )
    return (
        opened.withColumn("island", F.sum("opens").over(upto))
        .groupBy("provider", "provider_ticker", "security_id", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("island")
    )


def alias_overlaps(aliases: DataFrame) -> DataFrame:
    """Provider tickers that two securities hold on the same day, with the first such day.

    Intervals are reduced to one row per (ticker, start day) before the running
    maximum, so no pair of aliases is ever formed and a partition is bounded by
    the calendar.
    """
    by_start = (
        _intervals(aliases)
        .groupBy("provider", "provider_ticker", "start")
        .agg(F.count("*").alias("n"), F.max("end").alias("end"))
    )
    before = (
        Window.partitionBy("provider", "provider_ticker")
        .orderBy("start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    held = F.max("end").over(before) >= F.col("start")
    return (
        by_start.withColumn("clash", (F.col("n") > 1) | F.coalesce(held, F.lit(False)))
        .filter("clash")
        .groupBy("provider", "provider_ticker")
        .agg(F.min("start").alias("first_overlap"))
    )


def alias_issues(aliases: DataFrame) -> DataFrame:
    """Alias rows that lack a lineage field or whose interval is reversed."""
    blank = F.lit(False)
    for c in ("security_id", "provider", "provider_ticker", "evidence"):
        blank = blank | (F.coalesce(F.trim(F.col(c)), F.lit("")) == "")
    reversed_range = F.coalesce(F.col("valid_from") > F.col("valid_to"), F.lit(False))
    issue = F.when(blank, "lineage_field_missing").when(reversed_range, "invalid_date_range")
    return aliases.withColumn("issue", issue).filter(F.col("issue").isNotNull())


def resolve_alias(events: DataFrame, aliases: DataFrame) -> DataFrame:
    """Events with the one security their provider ticker meant on the event date.

    A ticker's merged intervals form one array row, so an event meets one row of
    the join. No match or several securities give ``UNRESOLVED``.
    """
    registry = (
        _intervals(aliases)
        .groupBy("provider", "provider_ticker")
        .agg(F.collect_list(F.struct("start", "end", "security_id")).alias("spans"))
    )
    key = _alias_key()
    keyed = events.withColumn("__p", key[0]).withColumn("__t", key[1])
    j = keyed.join(
        registry.select(F.col("provider").alias("__p"), F.col("provider_ticker").alias("__t"), "spans"),
        ["__p", "__t"],
        "left",
    )
    day = F.col("event_date")
    hits = F.filter(
        F.coalesce("spans", F.array().cast("array<struct<start:date,end:date,security_id:string>>")),
        lambda s: (s.getField("start") <= day) & (day <= s.getField("end")),
    )
    ids = F.array_distinct(hits.getField("security_id"))
    one = F.size(ids) == 1
    return j.select(
        *[F.col(c) for c in events.columns],
        F.when(one, F.try_element_at(ids, F.lit(1))).alias("security_id"),
        F.when(one, "RESOLVED").otherwise("UNRESOLVED").alias("resolution"),
    )


def repeated_keys(registry: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a registry names more than once, with the number of their rows; must be empty."""
    return registry.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def lifecycle_gate(members: DataFrame, registry: DataFrame, as_of: date | Column) -> DataFrame:
    """Members with ``allowed`` and the ``acquisition_ticker`` to use on ``as_of``.

    Blocking statuses bite from their effective date on; without one they never
    bite. A verified ticker change hands over to its successor from its date on.
    Each member gives one row: where a security is registered more than once
    (see ``repeated_keys``), any row in force may block it, and the row that
    came into force last gives status and ticker.
    """
    day = F.lit(as_of) if isinstance(as_of, date) else as_of
    begun = F.coalesce(day >= F.col("effective_date"), F.lit(False))
    blocks = F.coalesce(F.col("lifecycle_status").isin(*BLOCKING_STATUSES), F.lit(False)) & begun
    facts = F.struct("lifecycle_status", "effective_date", "successor_ticker")
    order = F.struct(begun.alias("begun"), "effective_date", "lifecycle_status", "successor_ticker")
    reg = registry.groupBy("security_id").agg(F.bool_or(blocks).alias("__blocked"), F.max_by(facts, order).alias("__last"))
    j = members.join(reg, "security_id", "left")
    status, successor = F.col("__last.lifecycle_status"), F.trim("__last.successor_ticker")
    moved = (
        status.eqNullSafe(F.lit(TICKER_CHANGE_STATUS))
        & F.coalesce(day >= F.col("__last.effective_date"), F.lit(False))
        & (F.coalesce(successor, F.lit("")) != "")
    )
    return j.select(
        *[F.col(c) for c in members.columns],
        status.alias("lifecycle_status"),
        (~F.coalesce("__blocked", F.lit(False))).alias("allowed"),
        F.when(moved, successor).otherwise(F.col("ticker")).alias("acquisition_ticker"),
    )


def provider_symbol_conflicts(symbols: DataFrame) -> DataFrame:
    """(security, ticker) keys registered more than once, as ``provider_symbol`` reads them; must be empty."""
    return repeated_keys(symbols.select("security_id", F.upper(F.trim("ticker")).alias("ticker")), ["security_id", "ticker"])


def provider_symbol(members: DataFrame, symbols: DataFrame) -> DataFrame:
    """Members with ``symbol``: the reviewed one for (security, ticker), else dots as dashes.

    Each member gives one row. Where a key is registered with different symbols
    none of them can be trusted, and ``symbol`` is null.
    """
    source = F.upper(F.trim("ticker"))
    reg = symbols.groupBy("security_id", source.alias("__t")).agg(F.min("symbol").alias("__lo"), F.max("symbol").alias("__hi"))
    j = members.withColumn("__t", source).join(reg, ["security_id", "__t"], "left")
    dashed = F.replace(F.col("__t"), F.lit("."), F.lit("-"))
    symbol = F.when(F.col("__lo") != F.col("__hi"), F.lit(None)).otherwise(F.coalesce("__lo", dashed))
    return j.select(*[F.col(c) for c in members.columns], symbol.alias("symbol"))
