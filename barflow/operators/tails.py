"""The stored rolling window and its readiness, kept up to date from what changed.

A window of the last ``n`` dates changes only by the rows that were added or
withdrawn, so an update reads the old window and the new rows. History is read
only for securities that lost a bar of their window, whose older bars move in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators.windows import readiness_of, rolling_tail
from barflow.schemas import BAR_COLUMNS, BAR_KEY


def advance_tail(tail: DataFrame, new_rows: DataFrame, n: int = 300) -> DataFrame:
    """The window after ``new_rows``: later dates push the oldest out, missing ones move in where they are late enough.

    Equal to the window of the whole history with the new rows, if ``tail`` was
    that of the history for the same ``n``. A date that the window holds keeps
    its bar, as stored bars are canonical.
    """
    stored = tail.select(*BAR_COLUMNS, F.lit(1).alias("__stored"))
    added = new_rows.filter(F.col("date").isNotNull()).select(*BAR_COLUMNS, F.lit(0).alias("__stored"))
    return rolling_tail(stored.unionByName(added), n, "__stored").select(*BAR_COLUMNS)


def withdraw_from_tail(tail: DataFrame, history: DataFrame, gone: DataFrame, n: int = 300) -> DataFrame:
    """The window after the bars of the keys ``gone`` have left ``history``.

    Only securities that lost a bar of their window are read from history again.
    """
    touched = tail.join(gone.select(*BAR_KEY).distinct(), BAR_KEY, "left_semi").select("security_id").distinct()
    kept = tail.join(touched, "security_id", "left_anti").select(*BAR_COLUMNS)
    return kept.unionByName(rolling_tail(history.join(touched, "security_id", "left_semi").select(*BAR_COLUMNS), n))


def restate_tickers(tail: DataFrame, names: DataFrame) -> DataFrame:
    """The window with the ticker of each (security_id, ticker) of ``names``; other securities keep theirs."""
    of = names.groupBy("security_id").agg(F.max("ticker").alias("__ticker"))
    named = tail.join(of, "security_id", "left").withColumn("ticker", F.coalesce("__ticker", "ticker"))
    return named.select(*BAR_COLUMNS)


def bar_counts(bars: DataFrame) -> DataFrame:
    """(security_id, available_bars): distinct dates of each security."""
    keys = bars.filter(F.col("date").isNotNull()).groupBy(*BAR_KEY).agg(F.lit(1).alias("one"))
    return keys.groupBy("security_id").agg(F.count("*").alias("available_bars"))


def advance_counts(counts: DataFrame, added: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """Counts after ``added`` bars (of keys that were absent) and ``gone`` ones (of keys that were held)."""
    parts = counts.select("security_id", "available_bars").unionByName(bar_counts(added))
    if gone is not None:
        parts = parts.unionByName(bar_counts(gone).withColumn("available_bars", -F.col("available_bars")))
    return parts.groupBy("security_id").agg(F.sum("available_bars").alias("available_bars")).filter("available_bars > 0")


def readiness_from_tail(
    members: DataFrame,
    tail: DataFrame,
    counts: DataFrame,
    reviewed: DataFrame | None = None,
    n: int = 300,
    minimum: int = 250,
) -> DataFrame:
    """``readiness`` of the history that ``tail`` and ``counts`` describe, without reading it."""
    if not 1 <= minimum <= n:
        raise ValueError("minimum must lie between 1 and n")
    edges = tail.groupBy("security_id").agg(F.min("date").alias("first_rolling_date"), F.max("date").alias("last_date"))
    facts = counts.join(edges, "security_id").select(
        "security_id",
        "available_bars",
        F.least(F.col("available_bars"), F.lit(n)).alias("rolling_bars"),
        "first_rolling_date",
        "last_date",
    )
    return readiness_of(members, facts, reviewed, minimum)
