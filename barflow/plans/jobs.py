"""End-to-end jobs composed of the operators: daily update, READY, EMA promotion."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.operators import continuity, corporate, ema, merge, normalize, tails, windows
from barflow.operators.universe import data_unavailable, operational
from barflow.schemas import BAR_COLUMNS, ContractError
from barflow.session import materialize
from barflow.sinks.publish import (
    Publication,
    fingerprint,
    load_snapshot,
    promote_ema,
    publish_ready,
    publish_snapshot,
    read_pointer,
)
from barflow.sinks.writers import upsert_daily


@dataclass(frozen=True)
class DailyUpdate:
    """Frames of one daily update; history itself is not touched yet."""

    new_rows: DataFrame
    history: DataFrame
    rolling: DataFrame
    readiness: DataFrame
    update_status: DataFrame
    gate: DataFrame


def daily_update(
    members: DataFrame,
    history: DataFrame,
    batch: DataFrame,
    single: DataFrame,
    lifecycle: DataFrame,
    cutoff: date,
    n: int = 300,
    minimum: int = 250,
    stored: tuple[DataFrame, DataFrame] | None = None,
) -> DailyUpdate:
    """Fold provider rows into history and bring the rolling window and readiness up to date.

    With ``stored``, the window of ``history`` for the same ``n`` and its
    ``bar_counts``, only these and the new rows are read for both; without it
    they are rebuilt from history.

    The accepted provider rows and the new rows are written to the shared folder;
    the frames returned read them from there. ``members`` are eligible. A security whose rows are unusable keeps its stored
    history (``stale_after_failure``); one that the lifecycle registry blocks is
    not acquired (``lifecycle_excluded``). Write outputs only when ``gate`` allows.
    """
    ids = history.select("security_id").distinct()
    working = operational(members, ids)
    gated = corporate.lifecycle_gate(working.select("security_id", "ticker"), lifecycle, cutoff)
    candidates = gated.filter("allowed").select("security_id")
    offered = lambda raw: raw.join(candidates, "security_id", "left_semi")
    # provider rows and new rows are small beside history and feed several outputs
    chosen = materialize(normalize.batch_then_single(offered(batch), offered(single)), "provider-rows")
    fetched = normalize.finalized_filter(chosen, cutoff).select(*BAR_COLUMNS)
    failed = normalize.batch_then_single_failed(offered(batch), offered(single), chosen)
    new_rows = materialize(merge.merge_append_rows(history, fetched), "new-rows")
    merged = history.select(*BAR_COLUMNS).unionByName(new_rows.select(*BAR_COLUMNS))
    # stored bars carry the ticker under which the security is acquired today
    names = gated.select("security_id", "acquisition_ticker")
    named = lambda df: df.join(names, "security_id").withColumn("ticker", F.col("acquisition_ticker")).select(*BAR_COLUMNS)
    reviewed = lifecycle.select("security_id")
    if stored is None:
        held = named(merged)
        rolling, ready = windows.rolling_tail(held, n), windows.readiness(members, held, reviewed, n, minimum)
    else:
        rolling = tails.advance_tail(named(stored[0]), named(new_rows), n)
        counts = tails.advance_counts(stored[1].join(names.select("security_id"), "security_id", "left_semi"), new_rows)
        ready = tails.readiness_from_tail(members, rolling, counts, reviewed, n, minimum)
    status = (
        gated.select("security_id", "allowed")
        .join(failed.withColumn("failed", F.lit(True)), "security_id", "left")
        .select(
            "security_id",
            F.when(~F.col("allowed"), "lifecycle_excluded")
            .when(F.col("failed"), "stale_after_failure")
            .otherwise("updated")
            .alias("update_status"),
        )
    )
    outcome = F.when(F.col("update_status") == "stale_after_failure", "failed").otherwise("updated")
    return DailyUpdate(
        new_rows=new_rows,
        history=merged,
        rolling=rolling,
        readiness=ready,
        update_status=status,
        gate=normalize.failure_rate_gate(status.select(outcome.alias("status"))),
    )


def write_daily_update(spark: SparkSession, update: DailyUpdate, root: str) -> None:
    """Write rolling rows, readiness, daily sections and history, if the gate allows.

    History comes last and is only appended to: until then the update can be run
    again from the same history, and afterwards its rows are found there.
    """
    gate = update.gate.first()
    if not gate["publish_allowed"]:
        raise ContractError(f"daily update refused: {gate['failed']} of {gate['attempted']} acquisitions failed")
    update.rolling.write.mode("overwrite").parquet(f"{root}/rolling")
    update.readiness.write.mode("overwrite").parquet(f"{root}/readiness")
    new = update.new_rows.select(*BAR_COLUMNS)
    upsert_daily(spark, f"{root}/daily", new, "volume")
    new.sortWithinPartitions("security_id", "date").write.mode("append").parquet(f"{root}/history")


def bootstrap_queue(
    members: DataFrame, history_ids: DataFrame, deferred: DataFrame
) -> DataFrame:
    """Members that still need a first history, with deferred ones labelled."""
    from barflow.operators.universe import partition_deferred

    return partition_deferred(data_unavailable(members, history_ids), deferred)


def publish_ready_snapshot(
    spark: SparkSession,
    rolling: DataFrame,
    readiness: DataFrame,
    root: str,
    cutoff: date,
    minimum: int,
    maximum: int,
    previous_as_of: date | None = None,
    quarantined: bool = False,
    source_unchanged: Callable[[], bool] | None = None,
) -> Publication:
    """Check, cut at the finalization date, test continuity and publish READY.

    Every check yields violation rows; the first non-empty one stops the job. The
    candidate is written once, and all later checks and the publication read it.
    """
    selected = readiness.filter(F.col("status") == "ready")
    frame = continuity.ready_filter(rolling, selected)
    bad = continuity.ready_filter_violations(rolling, selected, readiness, minimum, maximum)
    merge.raise_on_rows(bad, "READY rows rejected")
    final = materialize(normalize.finalized_filter(frame, cutoff), "ready-candidate")
    short = continuity.finalized_coverage_violations(final, selected, minimum)
    merge.raise_on_rows(short, "READY coverage rejected after finalization")
    if previous_as_of is not None:
        as_of = continuity.terminal_summary(final).first()["as_of_date"]
        if as_of is not None and as_of > previous_as_of:
            gaps = continuity.session_gaps(final, previous_as_of, as_of)
            merge.raise_on_rows(gaps, "READY recent-session continuity rejected")
    if source_unchanged is not None and not source_unchanged():
        raise ContractError("the source of READY changed while it was checked")
    return publish_ready(spark, final, root, quarantined)


def ready_job(
    spark: SparkSession,
    rolling: DataFrame,
    readiness: DataFrame,
    members: DataFrame,
    declared_ready: int,
    declared_compliant: int,
    quarantine: DataFrame,
    root: str,
    cutoff: date,
    minimum: int,
    maximum: int,
) -> Publication:
    """READY from its declared list, its predecessor and its quarantine registry.

    The list must agree with membership, continuity starts from the predecessor
    that is to be trusted, and the rolling rows must be the same before and after.
    """
    by_status = lambda ready: readiness.filter((F.col("status") == "ready") == ready)
    bad = continuity.ready_selection(by_status(True), members, by_status(False), declared_ready, declared_compliant)
    merge.raise_on_rows(bad, "READY list rejected")
    previous, quarantined = None, False
    pointer = read_pointer(spark, root)
    if pointer is not None:
        current = spark.createDataFrame([(pointer.as_of_date, pointer.fingerprint)], "as_of_date string, fingerprint string")
        trusted = continuity.trusted_predecessor(current, quarantine).first()
        if trusted["verdict"] != "usable":
            raise ContractError(f"READY predecessor rejected: {trusted['verdict']}")
        previous, quarantined = date.fromisoformat(trusted["previous_as_of"]), trusted["quarantined"]
    source = fingerprint(rolling, BAR_COLUMNS)
    return publish_ready_snapshot(
        spark, rolling, readiness, root, cutoff, minimum, maximum, previous, quarantined,
        lambda: fingerprint(rolling, BAR_COLUMNS) == source,
    )


def update_benchmark(spark: SparkSession, raw: DataFrame, root: str, cutoff: date) -> Publication:
    """Extend the published benchmark bars by a delivery and publish the result.

    Incomplete source rows are left out, but every other row must survive
    normalisation. The merge must be provably continuous for each benchmark; an
    unchanged result is reused, and a changed one of the same day is a new run.
    """
    labelled = normalize.split_incomplete(raw)
    checks = normalize.split_incomplete_checks(labelled)
    merge.raise_on_rows(checks.filter(F.col("duplicate_valid_dates") > 0), "benchmark dates repeated")
    typed = normalize.normalize_history(raw)
    merge.raise_on_rows(typed.filter(F.col("verdict") != "accepted"), "benchmark rows rejected")
    kept = typed.groupBy("security_id").agg(F.count("*").alias("kept"))
    lost = checks.join(kept, "security_id", "left").filter(
        F.col("valid_rows") != F.coalesce("kept", F.lit(0))
    )
    merge.raise_on_rows(lost, "benchmark rows lost in normalisation")
    new = normalize.finalized_filter(normalize.accepted(typed), cutoff)
    pointer = read_pointer(spark, root)
    if pointer is None:
        result = new
    else:
        old, _ = load_snapshot(spark, root)
        verdicts = merge.benchmark_verdicts(old, new)
        merge.raise_on_rows(
            verdicts.filter(~F.col("verdict").isin("append", "rebase")), "benchmark continuity rejected"
        )
        result = merge.benchmark_merge(old, new)
    as_of = result.agg(F.max("date").alias("d")).first()["d"]
    if as_of is None:
        raise ContractError("benchmark delivery holds no finalized bar")
    same_day = pointer is not None and pointer.as_of_date == as_of.isoformat()
    changed = same_day and fingerprint(result, BAR_COLUMNS)[1] != pointer.fingerprint
    return publish_snapshot(spark, result, root, as_of, recovery=changed)


def build_and_promote_ema(
    spark: SparkSession,
    ready: DataFrame,
    ready_fingerprint: str,
    history: DataFrame,
    previous: DataFrame | None,
    root: str,
    candidate_path: str,
    as_of: date,
    sample_size: int = 50,
    hints: DataFrame | None = None,
) -> Publication:
    """Update state, verify it against full recomputation, then promote it.

    The candidate is written first, so verification and promotion read the same
    rows and recompute nothing.
    """
    built = ema.ema_update(ready, history, previous, hints)
    built.write.mode("errorifexists").parquet(candidate_path)
    candidate = spark.read.parquet(candidate_path)
    merge.raise_on_rows(
        candidate.filter(F.col("error").isNotNull()).select("security_id", "error"), "EMA build failed"
    )
    absent = ready.select("security_id").distinct().join(candidate, "security_id", "left_anti")
    merge.raise_on_rows(absent, "EMA state does not cover READY")
    required = candidate.filter(F.col("route").isin("bootstrap", "rebuild")).select("security_id")
    picked = ema.required_plus_sample(candidate, required, sample_size)
    if not picked.filter(F.col("selection") == "unknown_required").isEmpty():
        raise ContractError("required securities are absent from the candidate")
    per_security = ema.ema_equivalence(candidate, history, picked, as_of)
    report = ema.ema_equivalence_report(per_security)
    return promote_ema(spark, candidate, report, root, as_of, ready_fingerprint)
