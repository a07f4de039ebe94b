"""Key-preserving merges of new rows into stored history.

Four policies, on purpose four operators: append only, exact sessions only,
replace proven-bad bars only, and replace a whole date. History is never
reshuffled as wide rows where only its keys are needed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.functions.keep import keep_first
from barflow.schemas import BAR_COLUMNS, BAR_KEY, BAR_VALUES, ContractError, require_columns
from barflow.session import materialize


def merge_append_rows(history: DataFrame, downloaded: DataFrame, order_col: str | None = None) -> DataFrame:
    """Rows of ``downloaded`` that history lacks, labelled ``addition`` or ``backfill``.

    Rows without a date are dropped, and a date downloaded twice keeps its first
    row by ``order_col`` (without one, the smallest values).

    Stored dates are canonical and never rewritten. Only the keys of history
    within the downloaded date range are compared, and only one row per security
    is needed for its last stored date.
    """
    require_columns(history, BAR_COLUMNS, "history")
    require_columns(downloaded, BAR_COLUMNS, "downloaded")
    first_new = downloaded.agg(F.min("date")).scalar()
    keys = history.filter(F.col("date") >= first_new).select(*BAR_KEY)
    last = history.groupBy("security_id").agg(F.max("date").alias("last_date"))
    order = [order_col] if order_col else [c for c in BAR_COLUMNS if c not in BAR_KEY]
    extra = [c for c in order if c not in BAR_COLUMNS]
    dated = downloaded.select(*BAR_COLUMNS, *extra).filter(F.col("date").isNotNull())
    fresh = keep_first(dated.join(keys, BAR_KEY, "left_anti"), BAR_KEY, order)
    is_backfill = F.col("date") <= F.col("last_date")
    return fresh.join(last, "security_id", "left").select(
        *BAR_COLUMNS, F.when(is_backfill, "backfill").otherwise("addition").alias("merge_class")
    )


def merge_append(history: DataFrame, downloaded: DataFrame, order_col: str | None = None) -> DataFrame:
    """History plus the later and the missing internal dates of ``downloaded``."""
    rows = merge_append_rows(history, downloaded, order_col).select(*BAR_COLUMNS)
    return history.select(*BAR_COLUMNS).unionByName(rows)


def merge_exact_violations(
    history: DataFrame, additions: DataFrame, targets: DataFrame
) -> DataFrame:
    """Reasons why the additions are not exactly the requested sessions.

    ``targets`` holds (security_id, date) keys. Per security, the first of: null
    or duplicate stored dates, null or duplicate repair dates, repair dates that
    differ from the targets, a target that history already has.
    """
    ids = targets.select("security_id").distinct()
    rows = (
        history.join(ids, "security_id", "left_semi")
        .select("security_id", "date", F.lit(1).alias("h"), F.lit(0).alias("a"), F.lit(0).alias("t"))
        .unionByName(
            additions.select(
                "security_id", "date", F.lit(0).alias("h"), F.lit(1).alias("a"), F.lit(0).alias("t")
            )
        )
        .unionByName(
            targets.select(
                "security_id", "date", F.lit(0).alias("h"), F.lit(0).alias("a"), F.lit(1).alias("t")
            )
        )
    )
    per_key = rows.groupBy(*BAR_KEY).agg(F.sum("h").alias("h"), F.sum("a").alias("a"), F.max("t").alias("t"))
    absent = F.col("date").isNull()
    some = lambda test: F.count_if(test) > 0
    reason = (
        F.when(some((F.col("h") > 0) & (absent | (F.col("h") > 1))), "history_null_or_duplicate_dates")
        .when(some((F.col("a") > 0) & (absent | (F.col("a") > 1))), "repair_null_or_duplicate_dates")
        .when(some((F.col("a") > 0) != (F.col("t") > 0)), "repair_rows_do_not_match_targets")
        .when(some((F.col("h") > 0) & (F.col("t") > 0)), "target_already_in_history")
    )
    return per_key.groupBy("security_id").agg(reason.alias("reason")).filter(F.col("reason").isNotNull())


def merge_exact(history: DataFrame, additions: DataFrame, targets: DataFrame) -> DataFrame:
    """Add exactly the target sessions of every security that passes all checks."""
    bad = merge_exact_violations(history, additions, targets).select("security_id")
    good = additions.join(bad, "security_id", "left_anti").select(*BAR_COLUMNS)
    return history.select(*BAR_COLUMNS).unionByName(good)


def preservation_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: old rows missing from or changed in ``after``, and rows added to it."""
    tagged = before.select(*BAR_COLUMNS, F.lit(1).alias("w")).unionByName(
        after.select(*BAR_COLUMNS, F.lit(-1).alias("w"))
    )
    # Grouping compares NULL with NULL and NaN with NaN as equal, which is what
    # "unchanged" means here.
    delta = tagged.groupBy(*BAR_COLUMNS).agg(F.sum("w").alias("w"))
    return delta.agg(
        F.coalesce(F.sum(F.when(F.col("w") > 0, F.col("w"))), F.lit(0)).alias("lost_rows"),
        F.coalesce(F.sum(F.when(F.col("w") < 0, -F.col("w"))), F.lit(0)).alias("added_rows"),
    )


def merge_replace_bad_plan(bars: DataFrame, evidence: DataFrame, replacements: DataFrame) -> DataFrame:
    """One row per evidence bar with ``action``.

    ``replaced`` only when the stored bar is unsound, equals the submitted
    evidence in all six values, and the replacement is sound. A stored bar that
    is already sound is ``unchanged``; the rest names the refusal. Evidence or a
    replacement given twice counts once; where the repeats differ, the bar is
    refused (``conflicting_evidence``, ``conflicting_replacement``). Of the stored
    bars and the replacements, only those with a key of the evidence are grouped;
    they are found by hashed keys, as sorting both sides would cost far more.
    """
    old, keys = _one_per_key(evidence, "ev"), evidence.select(*BAR_KEY).distinct().hint("shuffle_hash")
    new = _one_per_key(replacements.join(keys, BAR_KEY, "left_semi"), "new")
    stored = bars.join(keys, BAR_KEY, "left_semi")
    counts = stored.groupBy(*BAR_KEY).agg(
        F.count("*").alias("stored_rows"), F.min_by(F.struct(*BAR_VALUES), "ticker").alias("s")
    )
    flat = old.join(counts, BAR_KEY, "left").join(new, BAR_KEY, "left")
    flat = flat.select("*", "s.*")
    same = F.lit(True)
    for c in BAR_VALUES:
        # NaN evidence never equals a stored value, as in IEEE comparison.
        number = ~F.isnan(F.col(c).cast("double"))
        same = same & F.coalesce((F.col(c) == F.col(f"ev_{c}")) & number, F.lit(False))
    stored_ok = X.is_sound()
    checked = flat.withColumn("stored_ok", stored_ok).withColumn("same", same)
    for c in BAR_VALUES:
        checked = checked.withColumn(c, F.col(f"new_{c}"))
    new_ok = X.is_sound()
    action = (
        F.when(~F.col("stored_rows").eqNullSafe(F.lit(1)), "not_exactly_one_row")
        .when(F.col("stored_ok"), "unchanged")
        .when(F.col("ev_differ"), "conflicting_evidence")
        .when(F.coalesce("new_differ", F.lit(False)), "conflicting_replacement")
        .when(~F.col("same"), "differs_from_evidence")
        .when(~new_ok, "invalid_replacement")
        .otherwise("replaced")
    )
    return checked.select(*BAR_KEY, action.alias("action"), *[F.col(c) for c in BAR_VALUES])


def _one_per_key(rows: DataFrame, side: str) -> DataFrame:
    """One row per key with its prefixed values, and whether the rows of the key differ."""
    values = F.struct(*BAR_VALUES)
    held = rows.groupBy(*BAR_KEY).agg(F.min(values).alias("lo"), F.max(values).alias("hi"))
    flat = [F.col(f"lo.{c}").alias(f"{side}_{c}") for c in BAR_VALUES]
    return held.select(*BAR_KEY, *flat, (~F.col("lo").eqNullSafe(F.col("hi"))).alias(f"{side}_differ"))


def merge_replace_bad(bars: DataFrame, evidence: DataFrame, replacements: DataFrame) -> DataFrame:
    """Bars with proven-bad values replaced; never adds, deletes or moves a row."""
    plan = merge_replace_bad_plan(bars, evidence, replacements).filter(F.col("action") == "replaced")
    fix = plan.select(*BAR_KEY, F.struct(*BAR_VALUES).alias("fix"))
    merged = bars.select(*BAR_COLUMNS).join(fix, BAR_KEY, "left")
    values = [
        F.when(F.col("fix").isNotNull(), F.col(f"fix.{c}")).otherwise(F.col(c)).alias(c)
        for c in BAR_VALUES
    ]
    return merged.select("date", "security_id", "ticker", *values)


def _fresh_of(fresh: DataFrame, session: date) -> DataFrame:
    """One row per security of the session's fresh bars: how many there are, and the bar where it is one."""
    rest = [c for c in BAR_COLUMNS if c != "security_id"]
    held = fresh.filter(F.col("date") == F.lit(session)).groupBy("security_id")
    one = held.agg(F.count("*").alias("fresh_rows"), F.min(F.struct(*rest)).alias("f"))
    bar = F.when(F.col("fresh_rows") == 1, F.col("f"))
    return one.select("security_id", "fresh_rows", *[bar.getField(c).alias(c) for c in rest])


def merge_upsert_date_report(bars: DataFrame, fresh: DataFrame, session: date) -> DataFrame:
    """Per security on ``session``: before, after and what the upsert does.

    ``changed`` rows differ in at least one value, ``added`` ones were absent. A
    security with several fresh rows is left alone (``not_exactly_one_row``).
    """
    new = _fresh_of(fresh, session).select("security_id", "fresh_rows", *[F.col(c).alias(f"after_{c}") for c in BAR_VALUES])
    stored = bars.filter(F.col("date") == F.lit(session))
    old = stored.select("security_id", *[F.col(c).alias(f"before_{c}") for c in BAR_VALUES], F.lit(True).alias("had"))
    differs = F.lit(False)
    for c in BAR_VALUES:
        differs = differs | ~F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    change = (
        F.when(F.col("fresh_rows") > 1, "not_exactly_one_row")
        .when(F.col("had").isNull(), "added")
        .when(differs, "changed")
        .otherwise("same")
    )
    return new.join(old, "security_id", "left").withColumn("change", change).drop("had", "fresh_rows")


def merge_upsert_date(
    bars: DataFrame, fresh: DataFrame, session: date, only_if_absent: bool = False
) -> DataFrame:
    """Replace (or, with ``only_if_absent``, only add) the bar of one session.

    A security takes part only with exactly one fresh row, so keys stay unique.
    """
    day = F.col("date") == F.lit(session)
    new = _fresh_of(fresh, session).filter("fresh_rows = 1").select(*BAR_COLUMNS)
    stored = bars.select(*BAR_COLUMNS)
    if only_if_absent:
        present = stored.filter(day).select("security_id")
        return stored.unionByName(new.join(present, "security_id", "left_anti"))
    untouched = stored.filter(~day | F.col("date").isNull())
    kept = stored.filter(day).join(new.select("security_id"), "security_id", "left_anti")
    return untouched.unionByName(kept).unionByName(new)


# Tolerances of the overlap checks.
RTOL = 1e-7
ATOL = 1e-9


def benchmark_verdicts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per benchmark: may the new bars extend the old ones, and by which rebase factor?

    Both sides must be sound bars with unique dates. Closes must agree on the overlap. A change of the adjustment ratio passes
    only when it is one finite factor over at least two overlap rows; the factor
    of the first overlap row is then both the anchor of the comparison and the
    multiplier for the old adjusted closes.
    """
    o = old.select("security_id", "date", F.col("close").alias("oc"), F.col("adj_close").alias("oa"))
    n = new.select("security_id", "date", F.col("close").alias("nc"), F.col("adj_close").alias("na"))
    overlap = (
        o.join(n, BAR_KEY)
        .withColumn("old_ratio", X.safe_ratio("oa", "oc"))
        .withColumn("new_ratio", X.safe_ratio("na", "nc"))
        .withColumn("revision", X.safe_ratio("new_ratio", "old_ratio"))
    )
    first = overlap.groupBy("security_id").agg(F.min_by("revision", "date").alias("anchor"))
    checks = (
        overlap.join(first, "security_id")
        .groupBy("security_id")
        .agg(
            F.count("*").alias("overlap_rows"),
            F.bool_and(X.is_close("oc", "nc", RTOL, ATOL)).alias("closes_agree"),
            F.bool_and(X.is_close("old_ratio", "new_ratio", RTOL, ATOL)).alias("ratios_agree"),
            F.bool_and(X.is_finite("revision") & X.is_close("revision", "anchor", RTOL, ATOL)).alias(
                "uniform"
            ),
            F.max("anchor").alias("anchor"),
        )
    )
    ids = benchmark_input_checks(old, new)
    verdict = (
        F.when(F.col("invalid_input"), "invalid_bars")
        .when(F.col("overlap_rows").isNull(), "no_overlap")
        .when(~F.col("closes_agree"), "historical_closes_revised")
        .when(F.col("ratios_agree"), "append")
        .when((F.col("overlap_rows") >= 2) & F.col("uniform"), "rebase")
        .otherwise("adjustment_basis_changed")
    )
    return ids.join(checks, "security_id", "left").select(
        "security_id",
        F.coalesce("overlap_rows", F.lit(0)).alias("overlap_rows"),
        verdict.alias("verdict"),
        F.when(verdict == "rebase", F.col("anchor")).otherwise(F.lit(1.0)).alias("rebase_factor"),
    )


def benchmark_input_checks(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per benchmark of either side: does it hold an unsound bar, or a missing or repeated date?"""
    flaw = F.col("bad") | (F.col("n") > 1) | F.col("date").isNull()

    def side(df: DataFrame) -> DataFrame:
        rows = df.select(*BAR_COLUMNS).withColumn("bad", ~X.is_sound())
        per_date = rows.groupBy(*BAR_KEY).agg(F.count("*").alias("n"), F.bool_or("bad").alias("bad"))
        return per_date.groupBy("security_id").agg(F.bool_or(flaw).alias("invalid_input"))

    return side(old).unionByName(side(new)).groupBy("security_id").agg(F.bool_or("invalid_input").alias("invalid_input"))


def benchmark_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new benchmark bars of every accepted benchmark, new winning per date.

    Verdicts and the merged bars are written to the shared folder, so the check of
    the result and its reader compute nothing twice. Dates of accepted benchmarks
    are unique on either side.
    """
    verdicts = benchmark_verdicts(old, new).filter(F.col("verdict").isin("append", "rebase"))
    factor = materialize(verdicts.select("security_id", "rebase_factor", "verdict"), "verdicts")
    rebased = old.select(*BAR_COLUMNS).join(factor, "security_id").withColumn(
        "adj_close",
        F.when(F.col("verdict") == "rebase", F.col("adj_close") * F.col("rebase_factor")).otherwise(
            F.col("adj_close")
        ),
    )
    kept = rebased.select(*BAR_COLUMNS).join(new.select(*BAR_KEY), BAR_KEY, "left_anti")
    added = new.select(*BAR_COLUMNS).join(factor.select("security_id"), "security_id", "left_semi")
    merged = materialize(kept.unionByName(added.select(*BAR_COLUMNS)), "merged")
    # a rebase can leave the range of sound prices
    bad = merged.filter(~X.is_sound()).select(*BAR_KEY)
    raise_on_rows(bad, "benchmark bars unsound after the merge")
    return merged


def raise_on_rows(violations: DataFrame, what: str, samples: int = 5) -> None:
    """Raise when a violations frame, which must be empty, has rows."""
    shown = violations.limit(samples).collect()
    if shown:
        raise ContractError(f"{what}: {[r.asDict() for r in shown]}")


def set_algebra(left: DataFrame, right: DataFrame, key: str = "security_id") -> DataFrame:
    """Every id of either side with its membership: union, intersect and except in one pass."""
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    side: Column = (
        F.when((F.max("l") == 1) & (F.max("r") == 1), "both").when(F.max("l") == 1, "left_only").otherwise("right_only")
    )
    return tagged.groupBy(key).agg(side.alias("side"))
