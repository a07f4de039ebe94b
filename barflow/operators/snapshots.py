"""Comparison of a candidate snapshot with the canonical one."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.schemas import BAR_COLUMNS, BAR_KEY

# The compared columns in the order in which a change is reported. The
# reasons below (``duplicate_keys`` to ``pure_security_set_reduction``) are fixed too.
VALUES = ["ticker", "open", "high", "low", "close", "adj_close", "volume"]


def _differs(column: str) -> Column:
    """Changed value; missing equals missing, be it NULL or NaN."""
    return ~F.col(f"o_{column}").eqNullSafe(F.col(f"n_{column}"))


def _missing_columns(canonical: DataFrame, candidate: DataFrame) -> bool:
    needed = {*BAR_KEY, *VALUES}
    return not (needed <= set(canonical.columns) and needed <= set(candidate.columns))


def _key_rows(canonical: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row per key: how often each side has it and the values of either side.

    Each side is grouped by key before the sides meet, so duplicates on either
    are counted instead of multiplied by the join, and sides clustered by
    security are not shuffled. Keys with a NULL, which no join matches, are
    tagged, united and grouped. The ticker takes part as its hash: all buffers
    have a fixed width, so the aggregates hash and need no sort.
    """
    whole = F.col("security_id").isNotNull() & F.col("date").isNotNull()

    def value(df: DataFrame, c: str) -> Column:
        kind = df.schema[c].dataType
        if c == "ticker":
            return F.when(F.col(c).isNotNull(), F.xxhash64(c))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), F.col(c).cast("double"))
        return F.col(c)

    def grouped(df: DataFrame, s: str, n: str) -> DataFrame:
        values = [value(df, c).alias(f"{s}_{c}") for c in VALUES]
        rows = df.select(*BAR_KEY, *values).groupBy(*BAR_KEY)
        return rows.agg(F.count(F.lit(1)).alias(n), *[F.max(f"{s}_{c}").alias(f"{s}_{c}") for c in VALUES])

    columns = [*BAR_KEY, "old_n", "new_n", *[f"{s}_{c}" for s in "on" for c in VALUES]]
    counted = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("old_n", "new_n")]

    old, new = grouped(canonical.filter(whole), "o", "old_n"), grouped(candidate.filter(whole), "n", "new_n")
    met = old.join(new, BAR_KEY, "full_outer").select(*BAR_KEY, *counted, *columns[4:])
    sides = [grouped(df.filter(~whole), s, n) for df, s, n in ((canonical, "o", "old_n"), (candidate, "n", "new_n"))]
    rest = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy(*BAR_KEY).agg(*[F.max(c).alias(c) for c in columns[2:]])
    return met.unionByName(rest.select(*BAR_KEY, *counted, *columns[4:]))


def window_advance_diff(canonical: DataFrame, candidate: DataFrame, as_of: date) -> DataFrame:
    """One row: does the candidate only move some securities' windows forward?

    ``reason`` is the first of the rules that fails, in their fixed order, or
    ``pure_late_arrival_window_advance``; ``detail`` names the column or security and
    ``changed_rows`` counts the rows in which that column changed.
    """
    if _missing_columns(canonical, candidate):
        spark = canonical.sparkSession
        return spark.range(1).select(
            F.lit(False).alias("safe"),
            F.lit("missing_required_columns").alias("reason"),
            F.lit(None).cast("string").alias("detail"),
            F.lit(None).cast("long").alias("changed_rows"),
            *[F.lit(0).cast("long").alias(c) for c in ("removed_rows", "added_rows", "affected_securities")],
        )
    keys = _key_rows(canonical, candidate)
    both = (F.col("old_n") > 0) & (F.col("new_n") > 0)
    removed = (F.col("old_n") > 0) & (F.col("new_n") == 0)
    added = (F.col("old_n") == 0) & (F.col("new_n") > 0)
    per_id = keys.groupBy("security_id").agg(
        F.sum("old_n").alias("old_rows"),
        F.sum("new_n").alias("new_rows"),
        F.bool_or((F.col("old_n") > 1) | (F.col("new_n") > 1)).alias("dup"),
        *[F.count_if(both & _differs(c)).alias(f"chg_{c}") for c in VALUES],
        F.count_if(removed).alias("removed"),
        F.count_if(added).alias("added"),
        F.bool_or(added & (F.col("date") > F.lit(as_of))).alias("after"),
        F.max(F.when(removed, F.col("date"))).alias("last_removed"),
        F.min(F.when(added, F.col("date"))).alias("first_added"),
    )
    backward = (F.col("removed") != F.col("added")) | (
        (F.col("added") > 0) & (F.col("first_added") <= F.col("last_removed"))
    )
    total = per_id.agg(
        F.bool_or("dup").alias("dup"),
        F.bool_or((F.col("old_rows") == 0) | (F.col("new_rows") == 0)).alias("set_changed"),
        F.bool_or(F.col("old_rows") != F.col("new_rows")).alias("counts_changed"),
        *[F.sum(f"chg_{c}").alias(f"chg_{c}") for c in VALUES],
        F.coalesce(F.sum("removed"), F.lit(0)).alias("removed_rows"),
        F.coalesce(F.sum("added"), F.lit(0)).alias("added_rows"),
        F.bool_or("after").alias("after"),
        F.bool_or((F.col("removed") > 0) != (F.col("added") > 0)).alias("mismatch"),
        F.min(F.when(backward, F.col("security_id"))).alias("backward_id"),
        F.count_if(F.col("added") > 0).alias("affected_securities"),
    )
    changed = F.coalesce(*[F.when(F.col(f"chg_{c}") > 0, F.lit(c)) for c in VALUES])
    unbalanced = (
        (F.col("removed_rows") == 0)
        | (F.col("added_rows") == 0)
        | (F.col("removed_rows") != F.col("added_rows"))
    )
    reason = (
        F.when(F.col("dup"), "duplicate_keys")
        .when(F.col("set_changed"), "security_set_changed")
        .when(F.col("counts_changed"), "per_security_row_counts_changed")
        .when(changed.isNotNull(), "overlap_values_changed")
        .when(unbalanced, "not_balanced_window_shift")
        .when(F.col("after"), "added_after_as_of")
        .when(F.col("mismatch"), "affected_security_mismatch")
        .when(F.col("backward_id").isNotNull(), "not_forward_window_advance")
        .otherwise("pure_late_arrival_window_advance")
    )
    detail = F.when(reason == "overlap_values_changed", changed).when(
        reason == "not_forward_window_advance", F.col("backward_id")
    )
    return total.select(
        (reason == "pure_late_arrival_window_advance").alias("safe"),
        reason.alias("reason"),
        detail.alias("detail"),
        F.when(
            reason == "overlap_values_changed",
            F.coalesce(*[F.when(F.col(f"chg_{c}") > 0, F.col(f"chg_{c}")) for c in VALUES]),
        ).alias("changed_rows"),
        "removed_rows",
        "added_rows",
        "affected_securities",
    )


def window_advance_details(canonical: DataFrame, candidate: DataFrame) -> DataFrame:
    """Per affected security: removed and added dates, joined with ``|``."""
    keys = _key_rows(canonical, candidate).filter((F.col("old_n") == 0) | (F.col("new_n") == 0))
    dates = lambda test: F.array_join(
        F.sort_array(F.collect_list(F.when(test, F.col("date").cast("string")))), "|"
    )
    return keys.groupBy("security_id").agg(
        dates(F.col("new_n") == 0).alias("removed_dates"), dates(F.col("old_n") == 0).alias("added_dates")
    )


def set_reduction_diff(canonical: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: is the candidate the canonical snapshot minus whole securities?"""
    if _missing_columns(canonical, candidate):
        return canonical.sparkSession.range(1).select(
            F.lit(False).alias("safe"),
            F.lit("missing_required_columns").alias("reason"),
            F.lit(None).cast("string").alias("detail"),
            F.lit(0).cast("long").alias("removed_securities"),
        )
    keys = _key_rows(canonical, candidate)
    both = (F.col("old_n") > 0) & (F.col("new_n") > 0)
    per_id = keys.groupBy("security_id").agg(
        F.sum("old_n").alias("old_rows"),
        F.sum("new_n").alias("new_rows"),
        F.bool_or((F.col("old_n") > 1) | (F.col("new_n") > 1)).alias("dup"),
        F.count_if(~both).alias("one_sided"),
        *[F.count_if(both & _differs(c)).alias(f"chg_{c}") for c in VALUES],
    )
    kept = F.col("new_rows") > 0
    # keys that differ while the row count agrees show up as changed dates
    total = per_id.agg(
        F.bool_or("dup").alias("dup"),
        F.count_if(~kept).alias("removed_securities"),
        F.coalesce(F.bool_or(F.col("old_rows") == 0), F.lit(False)).alias("new_ids"),
        (
            F.coalesce(F.sum(F.when(kept, F.col("old_rows"))), F.lit(0))
            != F.coalesce(F.sum("new_rows"), F.lit(0))
        ).alias("rows_changed"),
        F.coalesce(F.sum(F.when(kept, F.col("one_sided"))), F.lit(0)).alias("moved"),
        *[F.sum(F.when(kept, F.col(f"chg_{c}"))).alias(f"chg_{c}") for c in VALUES],
    )
    changed = F.coalesce(
        F.when(F.col("moved") > 0, F.lit("date")),
        *[F.when(F.col(f"chg_{c}") > 0, F.lit(c)) for c in VALUES],
    )
    reason = (
        F.when(F.col("dup"), "duplicate_keys")
        .when((F.col("removed_securities") == 0) | F.col("new_ids"), "not_security_set_reduction")
        .when(F.col("rows_changed"), "retained_row_count_changed")
        .when(changed.isNotNull(), "retained_values_changed")
        .otherwise("pure_security_set_reduction")
    )
    return total.select(
        (reason == "pure_security_set_reduction").alias("safe"),
        reason.alias("reason"),
        F.when(reason == "retained_values_changed", changed).alias("detail"),
        "removed_securities",
    )


def removed_securities(canonical: DataFrame, candidate: DataFrame) -> DataFrame:
    return canonical.select("security_id").distinct().join(
        candidate.select("security_id").distinct(), "security_id", "left_anti"
    )


def stage_reconcile(
    members: DataFrame,
    history: DataFrame,
    rolling: DataFrame,
    ready: DataFrame,
    reference: DataFrame,
    declared_ready: DataFrame,
) -> DataFrame:
    """Eligible members with rows and last dates of every stage, side by side.

    Each stage is reduced to one row per security before any join. History is
    reduced per (security, date) first, so repeated and invalid dates count.
    """

    def per_id(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy("security_id").agg(
            F.count("*").alias(f"{prefix}_rows"), F.max("date").alias(f"{prefix}_last_date")
        )

    dates = history.groupBy("security_id", "date").agg(F.count("*").alias("n"))
    # a missing date counts as missing, and each repeat (also of a missing one) as repeat
    repeats = F.col("n") - 1
    problems = F.sum(F.when(F.col("date").isNull(), F.col("n") + repeats).otherwise(repeats))
    hist = dates.groupBy("security_id").agg(
        F.sum("n").alias("history_rows"),
        F.min("date").alias("history_first_date"),
        F.max("date").alias("history_last_date"),
        problems.alias("history_date_problems"),
    )
    absent = (
        rolling.select(*BAR_KEY)
        .distinct()
        .join(history.select(*BAR_KEY), BAR_KEY, "left_anti")
        .groupBy("security_id")
        .agg(F.count("*").alias("rolling_dates_absent_from_history"))
    )
    ref = reference.groupBy("security_id").agg(F.max("date").alias("reference_last_date"))
    declared = declared_ready.select("security_id").distinct().withColumn("declared_ready", F.lit(True))
    out = members.select("security_id", "ticker", "exchange")
    for right in (hist, per_id(rolling, "rolling"), per_id(ready, "ready"), ref, declared, absent):
        out = out.join(right, "security_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(
        "security_id",
        "ticker",
        "exchange",
        F.when(F.col("history_last_date").isNotNull(), "available")
        .when(F.col("history_rows").isNotNull(), "history_read_error")
        .otherwise("missing_history")
        .alias("history_status"),
        zero("history_rows"),
        "history_first_date",
        "history_last_date",
        zero("history_date_problems"),
        zero("rolling_rows"),
        "rolling_last_date",
        F.col("ready_rows").isNotNull().alias("in_ready"),
        zero("ready_rows"),
        "ready_last_date",
        F.coalesce("declared_ready", F.lit(False)).alias("declared_ready"),
        "reference_last_date",
        (F.col("ready_last_date") > F.col("reference_last_date")).alias("advanced_since_reference"),
        zero("rolling_dates_absent_from_history"),
    )


def not_eligible(stage: DataFrame, members: DataFrame) -> DataFrame:
    """Ids a stage holds although they are not eligible members."""
    return stage.select("security_id").distinct().join(
        members.select("security_id"), "security_id", "left_anti"
    )


def peer_lag(rows: DataFrame) -> DataFrame:
    """Adds ``peer_date``: the latest history date among the same exchange's members.

    The few exchanges are hot keys, so the maximum is aggregated (map side first)
    and joined back instead of being windowed per exchange.
    """
    peers = (
        rows.filter(F.col("exchange").isNotNull() & (F.col("exchange") != ""))
        .groupBy("exchange")
        .agg(F.max("history_last_date").alias("peer_date"))
    )
    return rows.join(peers, "exchange", "left")


def freshness_flags(rows: DataFrame, minimum: int = 250) -> DataFrame:
    """Adds ``flags`` (array) to a stage reconciliation that carries ``peer_date``."""
    available = F.col("history_status") == "available"
    h, r, y = (F.col(f"{s}_last_date") for s in ("history", "rolling", "ready"))
    in_ready = F.coalesce("in_ready", F.lit(False))
    flags = F.array_compact(
        F.array(
            F.when(~available, F.col("history_status")),
            F.when(available & (F.col("history_rows") < minimum), "insufficient_history"),
            F.when(
                available & F.col("peer_date").isNotNull() & (h < F.col("peer_date")),
                "behind_exchange_peers_calendar_unverified",
            ),
            F.when(available & ~r.eqNullSafe(h), "history_rolling_date_mismatch"),
            F.when(in_ready & ~y.eqNullSafe(r), "rolling_ready_date_mismatch"),
            F.when(~F.col("in_ready").eqNullSafe(F.col("declared_ready")), "readiness_export_membership_mismatch"),
            F.when(F.col("history_date_problems") > 0, "invalid_or_duplicate_history_dates"),
            F.when(F.col("rolling_dates_absent_from_history") > 0, "rolling_dates_absent_from_history"),
        )
    )
    return rows.withColumn("flags", flags)


def flag_counts(flagged: DataFrame) -> DataFrame:
    return flagged.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("securities"))


def membership_diff(previous: DataFrame | None, current: DataFrame) -> DataFrame:
    """Long change table: added, removed, ticker_change. No predecessor means no changes.

    Inputs are the eligible members (security_id, ticker), unique by id.
    """
    if previous is None:
        previous = current
    old = previous.select("security_id", F.col("ticker").alias("old_ticker"), F.lit(True).alias("was"))
    new = current.select("security_id", F.col("ticker").alias("new_ticker"), F.lit(True).alias("now"))
    change = (
        F.when(F.col("was").isNull(), "added")
        .when(F.col("now").isNull(), "removed")
        .when(~F.col("old_ticker").eqNullSafe(F.col("new_ticker")), "ticker_change")
    )
    return (
        old.join(new, "security_id", "full_outer")
        .select("security_id", change.alias("change_type"), "old_ticker", "new_ticker")
        .filter(F.col("change_type").isNotNull())
    )


def late_arrivals(epoch: DataFrame, rows: DataFrame, as_of: date, window: int) -> DataFrame:
    """Rows dated up to ``as_of`` against the snapshot published for that date, each with a reason.

    ``rows`` are bars with ``delivery``, the number of the delivery that brought
    them; of a key delivered more than once, or twice at once, only the first
    single one is more than ``duplicate_keys``. The reason is what the comparison
    of the snapshot with a candidate that takes in this row alone would say;
    ``detail`` names the changed column, or says why nothing moves: ``equal_bar``
    or ``before_window``. Rows without a date are no late arrivals. Only the
    epoch's rows of the delivered securities meet the rows; the bounds of the
    windows are one row per security.
    """
    late = rows.filter(F.col("date") <= F.lit(as_of))
    mine = epoch.join(late.select("security_id").distinct(), "security_id", "left_semi")
    return verdict_rows(late_verdicts(repeats_marked(late), {as_of: mine}, window))


def repeats_marked(rows: DataFrame) -> DataFrame:
    """Delivered rows dealt out by security, with ``repeated``: is a row not the single one of its key's first delivery?"""
    key = Window.partitionBy(*BAR_KEY)
    first, times = F.min("delivery").over(key), F.count("*").over(Window.partitionBy(*BAR_KEY, "delivery"))
    dealt = rows.filter("security_id is not null and date is not null").repartition("security_id")
    marked = dealt.select(*BAR_COLUMNS, "delivery", first.alias("__first"), times.alias("__times"))
    return marked.withColumn("repeated", (F.col("delivery") > F.col("__first")) | (F.col("__times") > 1)).drop("__first", "__times")


def late_verdicts(rows: DataFrame, epochs: dict[date, DataFrame], window: int) -> DataFrame:
    """Rows of ``repeats_marked`` with ``verdicts``: (as_of_date, reason, detail) for each snapshot not older than the row.

    Rows and snapshots meet by security, so rows are shuffled once for all
    snapshots, and snapshots clustered by security not at all.
    """
    plain = lambda c: F.when(~F.isnan(c), F.col(c)) if c[2:] in VALUES[1:6] else F.col(c)
    copies = Window.partitionBy(*BAR_KEY).orderBy("date")
    out, verdicts = rows, []
    for n, (as_of, epoch) in enumerate(epochs.items()):
        dealt = epoch.repartition("security_id")
        held = dealt.select(*BAR_KEY, *[F.col(c).alias(f"o_{c}") for c in VALUES], F.row_number().over(copies).alias("stored"))
        bounds = dealt.groupBy("security_id").agg(F.min("date").alias("window_start"), F.count("*").alias("window_rows"))
        joined = out.join(held, BAR_KEY, "left").join(bounds, "security_id", "left")
        changed = F.coalesce(*[F.when(~plain(f"o_{c}").eqNullSafe(F.when(~F.isnan(c), F.col(c)) if c in VALUES[1:6] else F.col(c)), F.lit(c)) for c in VALUES])
        stored = F.col("stored").isNotNull()
        reason = (
            F.when(F.col("repeated"), "duplicate_keys")
            .when(F.col("window_rows").isNull(), "security_set_changed")
            .when(stored & changed.isNotNull(), "overlap_values_changed")
            .when(stored, "not_balanced_window_shift")
            .when(F.col("window_rows") < window, "per_security_row_counts_changed")
            .when(F.col("date") > F.col("window_start"), "pure_late_arrival_window_advance")
            .otherwise("not_balanced_window_shift")
        )
        detail = F.when(reason == "overlap_values_changed", changed).when(
            reason == "not_balanced_window_shift", F.when(stored, "equal_bar").otherwise("before_window")
        )
        verdict = F.struct(F.lit(as_of).alias("as_of_date"), reason.alias("reason"), detail.alias("detail"))
        verdict = F.when(F.col("date") <= F.lit(as_of), verdict)
        copy = F.coalesce("stored", F.lit(1))
        out = joined.select(*out.columns, verdict.alias(f"__verdict{n}"), copy.alias(f"__copy{n}"))
        verdicts.append(n)
    # a key that one snapshot holds more than once repeats the row for that snapshot alone
    alone = lambda n: F.forall(F.array(F.lit(1), *[F.col(f"__copy{m}") for m in verdicts if m != n]), lambda c: c == 1)
    each = F.array_compact(F.array(*[F.when(alone(n), F.col(f"__verdict{n}")) for n in verdicts]))
    return out.select(*BAR_KEY, "delivery", *VALUES, each.alias("verdicts"))


def verdict_rows(judged: DataFrame) -> DataFrame:
    """One row for each verdict."""
    each = judged.select("*", F.explode("verdicts").alias("v"))
    return each.select("v.as_of_date", *BAR_KEY, "delivery", *VALUES, "v.reason", "v.detail")
