"""Cross-sectional continuity: terminal dates, session gaps, coverage, READY gates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.functions.keep import keep_last
from barflow.operators.corporate import lifecycle_gate
from barflow.schemas import BAR_COLUMNS, BAR_KEY, BAR_VALUES, require_columns


def terminal_histogram(bars: DataFrame) -> DataFrame:
    """Securities per last date."""
    last = bars.groupBy("security_id").agg(F.max("date").alias("terminal_date"))
    return last.groupBy("terminal_date").agg(F.count("*").alias("securities"))


def terminal_summary(bars: DataFrame) -> DataFrame:
    """One row: modal terminal date (ties go to the later one) and its verdict.

    A security that reaches beyond the modal date is a partial leading edge and
    the snapshot is rejected.
    """
    hist = terminal_histogram(bars)
    return hist.agg(
        F.max_by("terminal_date", F.struct("securities", "terminal_date")).alias("as_of_date"),
        F.max("securities").alias("as_of_security_count"),
        F.min("terminal_date").alias("terminal_date_min"),
        F.max("terminal_date").alias("terminal_date_max"),
        F.array_join(
            F.sort_array(
                F.collect_list(F.concat_ws(":", F.col("terminal_date").cast("string"), "securities"))
            ),
            "|",
        ).alias("terminal_date_histogram"),
    ).withColumn(
        "verdict",
        F.when(F.col("as_of_date").isNull(), "empty")
        .when(F.col("terminal_date_max") > F.col("as_of_date"), "partial_leading_edge")
        .otherwise("coherent"),
    )


def expected_sessions(bars: DataFrame, previous: date, candidate: date) -> DataFrame:
    """Sessions observed anywhere in ``(previous, candidate]``. Never invented."""
    span = (F.col("date") > F.lit(previous)) & (F.col("date") <= F.lit(candidate))
    return bars.filter(span).select("date").distinct()


def session_gaps(bars: DataFrame, previous: date, candidate: date) -> DataFrame:
    """(security_id, missing_session) of securities that reached ``candidate``.

    The session list and each security's dates in the span are both bounded by
    the days between the two dates. A security that never reached ``candidate``
    is stale, not gapped, and is left out.
    """
    require_columns(bars, BAR_KEY, "bars")
    span = (F.col("date") > F.lit(previous)) & (F.col("date") <= F.lit(candidate))
    inside = bars.filter(span).select(*BAR_KEY)
    sessions = inside.agg(F.collect_set("date")).scalar()
    # bars after the candidate also show that a security reached it
    later = bars.filter(F.col("date") > F.lit(previous)).select(*BAR_KEY)
    seen = later.groupBy("security_id").agg(
        F.max("date").alias("terminal"), F.collect_set("date").alias("present")
    )
    missing = F.array_except(sessions, F.col("present"))
    return seen.filter(F.col("terminal") >= F.lit(candidate)).select(
        "security_id", F.explode(missing).alias("missing_session")
    )


def session_gap_summary(bars: DataFrame, previous: date, candidate: date) -> DataFrame:
    """One row: expected sessions, gapped securities and missing bars."""
    gaps = session_gaps(bars, previous, candidate)
    expected = expected_sessions(bars, previous, candidate).agg(F.count("*")).scalar()
    per_id = gaps.groupBy("security_id").agg(F.count("*").alias("n"))
    return per_id.agg(
        F.count("*").alias("gap_security_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("missing_bars")
    ).withColumn("expected_sessions", expected)


def trusted_predecessor(current: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Current snapshot pointer -> the date continuity is checked from.

    ``current``: as_of_date, fingerprint. ``quarantine``: as_of_date, fingerprint,
    last_known_good. A quarantined snapshot falls back to its last good date; a
    match without one is reported as unusable.
    """
    q = quarantine.select(
        "as_of_date", "fingerprint", "last_known_good", F.lit(True).alias("quarantined")
    )
    hit = F.coalesce("quarantined", F.lit(False))
    return current.join(q, ["as_of_date", "fingerprint"], "left").select(
        "as_of_date",
        "fingerprint",
        hit.alias("quarantined"),
        F.when(hit, F.col("last_known_good")).otherwise(F.col("as_of_date")).alias("previous_as_of"),
        F.when(hit & F.col("last_known_good").isNull(), "quarantine_without_good_date")
        .otherwise("usable")
        .alias("verdict"),
    )


def bracketed_gap(bars: DataFrame, target: date) -> DataFrame:
    """Securities with bars before and after ``target`` but none on it, and their latest ticker."""
    t = F.lit(target)
    d = F.col("date")
    facts = bars.groupBy("security_id").agg(
        F.bool_or(d < t).alias("before"),
        F.bool_or(d > t).alias("after"),
        F.bool_or(d == t).alias("on"),
        F.max_by("ticker", "date").alias("ticker"),
    )
    return facts.filter(F.col("before") & F.col("after") & ~F.col("on")).select("security_id", "ticker")


def session_presence(members: DataFrame, bars: DataFrame, session: date) -> DataFrame:
    """Each member with whether it has a bar on ``session``."""
    on = bars.filter(F.col("date") == F.lit(session)).select("security_id").distinct()
    return members.select("security_id").join(
        on.withColumn("present", F.lit(True)), "security_id", "left"
    ).select("security_id", F.coalesce("present", F.lit(False)).alias("present"))


def session_coverage(
    members: DataFrame, bars: DataFrame, session: date, minimum_present: int | None = None
) -> DataFrame:
    """One row: members allowed, present and absent on a session, and the optional floor."""
    p = session_presence(members, bars, session)
    out = p.agg(
        F.count("*").alias("allowed"),
        F.count_if("present").alias("present"),
        F.count_if(~F.col("present")).alias("absent"),
    )
    floor = F.lit(minimum_present if minimum_present is not None else 0)
    return out.withColumn("enough", F.col("present") >= floor)


def allowed_coverage(members: DataFrame, registry: DataFrame, bars: DataFrame, session: date) -> DataFrame:
    """One row: eligible members, those with history, those whose lifecycle allows a bar on ``session``, and of these present and absent.

    ``members`` are the eligible ones. History is reduced to two facts per
    security before it meets them, so it is read once and moved as one row each.
    """
    facts = bars.groupBy("security_id").agg(
        F.coalesce(F.bool_or(F.col("date") == F.lit(session)), F.lit(False)).alias("present")
    )
    ids = members.select("security_id", "ticker").dropDuplicates(["security_id"])
    gated = lifecycle_gate(ids, registry, session).select("security_id", F.col("allowed").alias("may"))
    rows = gated.join(facts.withColumn("operational", F.lit(True)), "security_id", "left")
    counted = F.col("operational") & F.col("may")
    return rows.agg(
        F.count("*").alias("eligible"),
        F.count_if("operational").alias("operational"),
        F.count_if(counted).alias("allowed"),
        F.count_if(counted & F.col("present")).alias("present"),
        F.count_if(counted & ~F.col("present")).alias("absent"),
    )


def gap_evidence(gaps: DataFrame, history: DataFrame) -> DataFrame:
    """For each gap: is the session in source history, with which values, and how far it goes.

    History is reduced to the gapped securities before anything is shuffled.
    """
    ids = gaps.select("security_id").distinct()
    source = history.join(ids, "security_id", "left_semi")
    latest = source.groupBy("security_id").agg(
        F.max("date").alias("history_latest_date"), F.count("*").alias("history_rows")
    )
    # a date that history repeats must not multiply the gap
    rows = keep_last(source.select(*BAR_KEY, *BAR_VALUES), BAR_KEY, BAR_VALUES).withColumnRenamed("date", "missing_session")
    return (
        gaps.join(rows.withColumn("in_history", F.lit(True)), ["security_id", "missing_session"], "left")
        .join(latest, "security_id", "left")
        .select(
            "security_id",
            "missing_session",
            F.coalesce("in_history", F.lit(False)).alias("in_history"),
            *BAR_VALUES,
            F.coalesce("history_rows", F.lit(0)).alias("history_rows"),
            "history_latest_date",
        )
    )


def ready_selection(
    declared: DataFrame,
    members: DataFrame,
    excluded: DataFrame,
    declared_ready: int,
    declared_compliant: int,
) -> DataFrame:
    """Violations of the READY consistency gate; empty means the list may be used.

    ``members`` are the eligible ones; ``excluded`` the insufficient and
    unavailable ids. Duplicates, emptiness and stale counts are whole-list rules
    (security_id NULL); the rest names the security.
    """
    per_id = declared.groupBy("security_id").agg(F.count("*").alias("n"))
    listed = per_id.agg(F.count("*").alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("entries"))
    compliant = members.select("security_id").distinct().agg(F.count("*")).scalar()
    counts = listed.withColumn("compliant", compliant)
    rules = F.array_compact(
        F.array(
            F.when(F.col("compliant") != declared_compliant, F.lit("eligibility_count_stale")),
            F.when(F.col("ids") == 0, F.lit("empty_ready_list")),
            F.when(
                (F.col("ids") != F.col("entries")) | (F.col("ids") != declared_ready),
                F.lit("inconsistent_ready_ids"),
            ),
        )
    )
    whole = counts.select(F.lit(None).cast("string").alias("security_id"), F.explode(rules).alias("violation"))
    alien = per_id.join(members.select("security_id"), "security_id", "left_anti").select(
        "security_id", F.lit("not_eligible").alias("violation")
    )
    overlap = per_id.join(excluded.select("security_id"), "security_id", "left_semi").select(
        "security_id", F.lit("ready_and_excluded").alias("violation")
    )
    blank = per_id.filter(F.coalesce(F.trim("security_id"), F.lit("")) == "").select(
        "security_id", F.lit("blank_ready_id").alias("violation")
    )
    return whole.unionByName(alien).unionByName(overlap).unionByName(blank)


def ready_filter_violations(
    rolling: DataFrame, selected: DataFrame, details: DataFrame, minimum: int, maximum: int
) -> DataFrame:
    """Per READY security, the first rule its rolling rows break; empty means sound.

    ``details``: security_id, rolling_bars, last_date as declared by readiness.
    """
    require_columns(rolling, BAR_COLUMNS, "rolling")
    ids = selected.select("security_id").distinct()
    rows = rolling.join(ids, "security_id", "left_semi").withColumn("bad", ~X.is_sound())
    per_date = rows.groupBy("security_id", "date").agg(
        F.count("*").alias("n"), F.bool_or("bad").alias("bad")
    )
    facts = per_date.groupBy("security_id").agg(
        F.sum("n").alias("rows"),
        F.max("date").alias("last_seen"),
        F.bool_or((F.col("n") > 1) | F.col("date").isNull()).alias("bad_keys"),
        F.bool_or("bad").alias("bad"),
    )
    want = details.select(
        "security_id", F.col("rolling_bars").alias("want_rows"), F.col("last_date").alias("want_last")
    )
    violation = (
        F.when(F.col("rows").isNull(), "no_rolling_data")
        .when(F.col("bad_keys"), "null_or_duplicate_dates")
        .when((F.col("rows") < minimum) | (F.col("rows") > maximum), "row_count_outside_thresholds")
        .when(
            ~F.col("rows").eqNullSafe(F.col("want_rows")) | ~F.col("last_seen").eqNullSafe(F.col("want_last")),
            "disagrees_with_readiness",
        )
        .when(F.col("bad"), "qc_rejected")
    )
    return (
        ids.join(facts, "security_id", "left")
        .join(want, "security_id", "left")
        .select("security_id", F.coalesce("rows", F.lit(0)).alias("rows"), violation.alias("violation"))
        .filter(F.col("violation").isNotNull())
    )


def ready_filter(rolling: DataFrame, selected: DataFrame) -> DataFrame:
    """Rolling rows of the READY securities."""
    return rolling.select(*BAR_COLUMNS).join(
        selected.select("security_id").distinct(), "security_id", "left_semi"
    )


def finalized_coverage_violations(finalized: DataFrame, selected: DataFrame, minimum: int) -> DataFrame:
    """READY securities that fall below ``minimum`` bars once the cutoff is applied."""
    counts = finalized.groupBy("security_id").agg(F.count("*").alias("rows"))
    return (
        selected.select("security_id")
        .distinct()
        .join(counts, "security_id", "left")
        .select("security_id", F.coalesce("rows", F.lit(0)).alias("rows"))
        .filter(F.col("rows") < minimum)
    )
