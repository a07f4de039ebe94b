"""Membership, onboarding queues, screening freshness, review queue and status."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.schemas import ContractError, require_columns

# The single eligibility rule and the status vocabularies.
ELIGIBLE = "COMPLIANT"
FRESHNESS_STATUSES = (
    "POST_EARNINGS_REFRESHED",
    "AWAITING_NEXT_EARNINGS",
    "POTENTIALLY_STALE",
    "UNKNOWN",
)
MARKET_CATEGORIES = ("DATA_UNAVAILABLE", "INSUFFICIENT_HISTORY", "DAILY_UPDATE_FAILED")


def is_eligible(column: str = "sharia_compliance") -> Column:
    """Exactly the eligible value; NULL and every other rating are not."""
    return F.col(column).eqNullSafe(F.lit(ELIGIBLE))


def eligible(members: DataFrame, column: str = "sharia_compliance") -> DataFrame:
    """Eligible members that carry an id and a ticker."""
    named = (F.coalesce("security_id", F.lit("")) != "") & (F.coalesce("ticker", F.lit("")) != "")
    return members.filter(is_eligible(column) & named)


def operational(members: DataFrame, history_ids: DataFrame) -> DataFrame:
    """Eligible members that have history."""
    return members.join(history_ids.select("security_id"), "security_id", "left_semi")


def data_unavailable(
    members: DataFrame, history_ids: DataFrame, reviewed: DataFrame | None = None
) -> DataFrame:
    """Eligible members without history, minus those reviewed as not to be retried."""
    missing = members.join(history_ids.select("security_id"), "security_id", "left_anti")
    if reviewed is None:
        return missing
    return missing.join(reviewed.select("security_id"), "security_id", "left_anti")


def partition_deferred(missing: DataFrame, deferred: DataFrame) -> DataFrame:
    """Missing members as ``RETRYABLE`` or ``DEFERRED_NO_RETRY``, matched by id, never by ticker."""
    reg = deferred.select("security_id", "reason", "event_date", F.lit(True).alias("__hit"))
    j = missing.join(reg, "security_id", "left")
    return j.withColumn(
        "status", F.when(F.col("__hit"), "DEFERRED_NO_RETRY").otherwise("RETRYABLE")
    ).drop("__hit")


def new_member_gate(partitioned: DataFrame, max_new_members: int = 50) -> DataFrame:
    """One row: retryable and deferred counts, and whether an automatic run is allowed."""
    out = partitioned.agg(
        F.count_if(F.col("status") == "RETRYABLE").alias("retryable"),
        F.count_if(F.col("status") == "DEFERRED_NO_RETRY").alias("deferred"),
    )
    return out.withColumn("allowed", F.col("retryable") <= max_new_members)


def deferred_issues(deferred: DataFrame) -> DataFrame:
    """Dispositions without an id, and ids listed twice."""
    key = F.coalesce(F.trim("security_id"), F.lit(""))
    counts = deferred.groupBy(key.alias("security_id")).agg(F.count("*").alias("n"))
    issue = F.when(F.col("security_id") == "", "missing_security_id").when(F.col("n") > 1, "duplicate_security_id")
    return counts.withColumn("issue", issue).filter(F.col("issue").isNotNull())


def review_plan(candidates: DataFrame, members: DataFrame, column: str = "sharia_compliance") -> DataFrame:
    """Plan candidates as ``selected`` (still eligible) or ``excluded``."""
    ok = members.filter(is_eligible(column)).select("security_id", F.lit(True).alias("__ok"))
    return candidates.join(ok, "security_id", "left").withColumn(
        "plan_status", F.when(F.col("__ok"), "selected").otherwise("excluded")
    ).drop("__ok")


def review_plan_violations(
    candidates: DataFrame,
    deferred: DataFrame,
    members: DataFrame,
    plan_snapshot: str,
    member_snapshot: str,
    declared_count: int | None = None,
) -> DataFrame:
    """Reasons why a plan may not be used; empty means usable."""
    tag = lambda df, n: df.select("security_id", F.lit(n).alias("src"))
    rows = tag(candidates, "c").unionByName(tag(deferred, "d")).unionByName(tag(members, "m"))
    src = F.col("src")
    per_id = rows.groupBy("security_id").agg(
        F.count_if(src == "c").alias("c"), F.count_if(src == "d").alias("d"), F.count_if(src == "m").alias("m")
    )
    per_id = per_id.select(
        "security_id",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("m") > 1, F.lit("duplicate_membership_id")),
                    F.when(F.col("c") > 1, F.lit("duplicate_candidate")),
                    F.when((F.col("c") > 0) & (F.col("d") > 0), F.lit("candidate_also_deferred")),
                )
            )
        ).alias("violation"),
    )
    whole = members.agg(F.count("*").alias("n")).select(
        F.lit(None).cast("string").alias("security_id"),
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.lit(plan_snapshot != member_snapshot), F.lit("snapshot_changed")),
                    F.when(
                        F.lit(declared_count is not None) & (F.col("n") != F.lit(declared_count or 0)),
                        F.lit("membership_count_mismatch"),
                    ),
                )
            )
        ).alias("violation"),
    )
    return whole.unionByName(per_id)


def repair_queue(
    missing: DataFrame, known_reasons: DataFrame, failures: DataFrame, still_unavailable: DataFrame
) -> DataFrame:
    """Missing members with a category and the last recorded failure.

    ``failures`` holds one row per security (see ``latest_failure_log``).
    """
    known = known_reasons.select("security_id", F.col("reason").alias("known_reason"))
    last = failures.select("security_id", "symbol", "error", "manifest_key")
    lasting = still_unavailable.select("security_id").distinct().withColumn("__lasting", F.lit(True))
    j = (
        missing.select("security_id", "ticker")
        .join(known, "security_id", "left")
        .join(last, "security_id", "left")
        .join(lasting, "security_id", "left")
    )
    category = (
        F.when(F.col("known_reason").isNotNull(), "delisted_or_merger")
        .when(F.col("__lasting"), "persistent_unavailable")
        .otherwise("retry_required")
    )
    return j.select(
        "security_id",
        "ticker",
        "symbol",
        category.alias("category"),
        F.coalesce("error", F.lit("no failed record found")).alias("error"),
        "known_reason",
        "manifest_key",
    )


def repair_counts(queue: DataFrame) -> DataFrame:
    """Securities per repair category."""
    return queue.groupBy("category").agg(F.count("*").alias("securities"))


def added_subset(changes: DataFrame, members: DataFrame, history_ids: DataFrame) -> DataFrame:
    """Newly added securities that are eligible and still without history."""
    added = changes.filter(F.col("change_type") == "added").select("security_id")
    return data_unavailable(members.join(added, "security_id", "left_semi"), history_ids)


def retry_subset(queue: DataFrame, members: DataFrame) -> DataFrame:
    """Retry candidates that are still eligible members."""
    return queue.filter(F.col("category") == "retry_required").join(
        members.select("security_id"), "security_id", "left_semi"
    )


def screening_freshness(rows: DataFrame, snapshot: date | Column, as_of: date | Column) -> DataFrame:
    """Adds ``freshness_status`` and ``freshness_reason`` from next_earnings_date, updated_at and updated_date.

    A recorded earnings date in the future awaits; today's is unknown; one from
    the snapshot on that has passed is potentially stale, and so is an earlier one
    when every known update is older still. Generic update times prove nothing
    more.
    """
    snap = F.lit(snapshot) if isinstance(snapshot, date) else snapshot
    today = F.lit(as_of) if isinstance(as_of, date) else as_of
    earnings = X.leading_date("next_earnings_date")
    updated = F.greatest(X.leading_date("updated_at"), X.leading_date("updated_date"))
    cases = [
        (earnings.isNull(), "UNKNOWN", "no_usable_earnings_date"),
        (earnings > today, "AWAITING_NEXT_EARNINGS", "earnings_date_ahead"),
        (earnings == today, "UNKNOWN", "earnings_date_today"),
        (earnings >= snap, "POTENTIALLY_STALE", "earnings_since_snapshot"),
        (updated < earnings, "POTENTIALLY_STALE", "earnings_after_updates"),
        (F.lit(True), "UNKNOWN", "updates_prove_nothing"),
    ]
    status = F.coalesce(*[F.when(test, F.lit(name)) for test, name, _ in cases])
    reason = F.coalesce(*[F.when(test, F.lit(why)) for test, _, why in cases])
    return rows.withColumns({"freshness_status": status, "freshness_reason": reason})


def screening_report(members: DataFrame, master: DataFrame, snapshot: date, as_of: date) -> DataFrame:
    """Eligible members with the freshness of their recorded screening."""
    if snapshot > as_of:
        raise ContractError("snapshot date lies in the future")
    source = master.select(
        "security_id", "next_earnings_date", "updated_at", "updated_date", F.lit(True).alias("in_master")
    )
    j = members.select("security_id", "ticker").join(source, "security_id", "left")
    out = screening_freshness(j, snapshot, as_of)
    return out.withColumn("in_master", F.coalesce("in_master", F.lit(False)))


def screening_counts(report: DataFrame) -> DataFrame:
    """One row: a count per status (absent ones are 0) and the rows audited."""
    s = F.col("freshness_status")
    return report.agg(
        F.count("*").alias("securities_audited"),
        *[F.count_if(s == name).alias(name.lower()) for name in FRESHNESS_STATUSES],
    )


# Reasons that the queue's readers know.
NO_DATA = "No historical OHLCV data available"
SKIPPED = "Verified lifecycle state; daily acquisition skipped"
HELD = "Daily update failed; data held at last known state"

QUEUE_COLUMNS = [
    "security_id", "ticker", "category", "reason",
    "recorded_earnings_date", "last_market_date", "screening_updated_at",
]


def review_queue(
    freshness: DataFrame | None,
    readiness_detail: DataFrame,
    members: DataFrame,
    updates: DataFrame | None = None,
    minimum: int = 250,
    target: int = 300,
) -> DataFrame:
    """Everything a reviewer has to look at, one row per security and category.

    ``updates``: security_id, update_status (``lifecycle_excluded`` or
    ``stale_after_failure``). A missing ticker falls back to the membership's.
    Sort by category, ticker, id with :func:`queue_order` when presenting it.
    """
    none = F.lit(None)
    d = readiness_detail.select("security_id", "ticker", "rolling_bars", "last_date", "status")

    def part(
        df: DataFrame, category: Column, reason: Column, earnings: Column, last: Column, updated: Column = none
    ) -> DataFrame:
        return df.select(
            "security_id",
            "ticker",
            category.alias("category"),
            reason.cast("string").alias("reason"),
            earnings.cast("string").alias("recorded_earnings_date"),
            last.cast("date").alias("last_market_date"),
            updated.cast("string").alias("screening_updated_at"),
        )

    status_category = (
        F.when(F.col("status") == "insufficient", "INSUFFICIENT_HISTORY")
        .when(F.col("status") == "unavailable", "DATA_UNAVAILABLE")
        .when(F.col("status") == "reviewed_no_retry", "REVIEWED_NO_RETRY")
    )
    bars_text = F.concat(
        F.col("rolling_bars").cast("string"), F.lit(f" of {minimum} minimum bars ({target} target)")
    )
    reason = F.when(F.col("status") == "insufficient", bars_text).when(
        F.col("status") == "unavailable", NO_DATA
    )
    held = F.when(F.col("status") == "insufficient", F.col("last_date"))
    queue = part(d.filter(F.col("status") != "ready"), status_category, reason, none, held)
    if freshness is not None:
        f = freshness.filter(F.col("freshness_status").isin("POTENTIALLY_STALE", "UNKNOWN"))
        queue = queue.unionByName(
            part(
                f,
                F.col("freshness_status"),
                F.col("freshness_reason"),
                F.col("next_earnings_date"),
                none,
                F.coalesce("updated_at", "updated_date"),
            )
        )
    if updates is not None:
        u = updates.filter(F.col("update_status").isin("lifecycle_excluded", "stale_after_failure"))
        u = u.join(d.drop("status"), "security_id", "left")
        excluded = F.col("update_status") == "lifecycle_excluded"
        queue = queue.unionByName(
            part(
                u,
                F.when(excluded, "LIFECYCLE_EXCLUDED").otherwise("DAILY_UPDATE_FAILED"),
                F.when(excluded, SKIPPED).otherwise(HELD),
                none,
                F.col("last_date"),
            )
        )
    names = members.select("security_id", F.col("ticker").alias("member_ticker"))
    return queue.join(names, "security_id", "left").withColumn(
        "ticker", F.coalesce("ticker", "member_ticker")
    ).select(*QUEUE_COLUMNS)


def queue_order(queue: DataFrame) -> DataFrame:
    return queue.orderBy("category", F.coalesce("ticker", F.lit("")), F.coalesce("security_id", F.lit("")))


def attach_reviews(queue: DataFrame, registry: DataFrame, snapshot: str) -> DataFrame:
    """Queue rows with the review recorded for the same security, ticker, scope and snapshot."""
    scope = F.when(F.col("category").isin(*MARKET_CATEGORIES), "market_data").otherwise("screening")
    reg = registry.filter(F.col("snapshot_date") == F.lit(snapshot)).select(
        "security_id", "ticker", "scope", "reviewed_at", "finding", "source_url", F.lit(True).alias("__hit")
    )
    j = queue.withColumn("scope", scope).join(reg, ["security_id", "ticker", "scope"], "left")
    return j.select(
        *[F.col(c) for c in queue.columns],
        "scope",
        F.when(F.col("__hit"), "REVIEWED_FOLLOW_UP_REQUIRED").otherwise("DETECTED_ONLY").alias("review_status"),
        "reviewed_at",
        "finding",
        "source_url",
    )


def review_registry_issues(registry: DataFrame) -> DataFrame:
    """Registry rows that may not be used, with the reason."""
    key = ["security_id", "ticker", "scope", "snapshot_date"]
    require_columns(registry, [*key, "source_url", "reviewed_at", "finding", "resolution"], "registry")
    https = F.coalesce(F.col("source_url").rlike("^https://[^/]+"), F.lit(False))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    per_row = (
        F.when(~https | blank("reviewed_at") | blank("finding"), "evidence_missing")
        .when(
            ~F.col("scope").eqNullSafe(F.lit("market_data"))
            | ~F.col("resolution").eqNullSafe(F.lit("FOLLOW_UP_REQUIRED")),
            "unsupported_scope_or_resolution",
        )
    )
    grouped = registry.groupBy(*key).agg(F.count("*").alias("n"), F.min(per_row).alias("row_issue"))
    issue = F.when(F.col("n") > 1, "duplicate_record").otherwise(F.col("row_issue"))
    return grouped.withColumn("issue", issue).filter(F.col("issue").isNotNull()).select(*key, "issue")


def status_summary(
    readiness_summary: DataFrame,
    changes: DataFrame,
    screening: DataFrame | None,
    update_failures: DataFrame,
) -> DataFrame:
    """One row of counts; DEGRADED when any update failed.

    ``coverage_ok`` is the identity that the screening counts add up to the
    eligible universe; NULL when no screening of this snapshot exists.
    """
    c = F.col("change_type")
    change = changes.agg(
        F.count_if(c == "added").alias("added"),
        F.count_if(c == "removed").alias("removed"),
        F.count_if(c == "ticker_change").alias("ticker_changes"),
    )
    failed = update_failures.agg(F.count("*")).scalar()
    names = [s.lower() for s in FRESHNESS_STATUSES]
    # one struct per source, so each is evaluated once
    out = readiness_summary.withColumn("__c", change.select(F.struct("*")).scalar()).select("*", "__c.*").drop("__c")
    if screening is None:
        out = out.withColumns({n: F.lit(None).cast("long") for n in names})
    else:
        out = out.withColumn("__s", screening.select(F.struct(*names)).scalar()).select("*", "__s.*").drop("__s")
    total = F.col(names[0])
    for name in names[1:]:
        total = total + F.col(name)
    return (
        out.withColumn("update_failures", failed)
        .withColumn("coverage_ok", total == F.col("confirmed_compliant"))
        .withColumn("pipeline_status", F.when(F.col("update_failures") > 0, "DEGRADED").otherwise("OPERATIONAL"))
    )
