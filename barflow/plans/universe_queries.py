"""Queries over membership, queues, freshness, status, explorer and inventory."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.operators import explorer as P
from barflow.operators import merge as M
from barflow.operators import reconcile as R
from barflow.operators import snapshots as S
from barflow.operators import universe as U
from barflow.operators import windows as W
from barflow.plans import bar_queries as B
from barflow.plans import fixtures as fx
from barflow.plans.catalog import query
from barflow.plans.fixtures import with_ctes
from barflow.schemas import BAR_KEY
from barflow.session import clustered


@query("eligible", with_ctes("members", "SELECT security_id, ticker FROM members WHERE sharia_compliance = 'COMPLIANT'"))
def eligible(spark, folder):
    return U.eligible(fx.members(spark, folder)).select("security_id", "ticker")


@query(
    "operational",
    with_ctes("eligible_members history_ids", "SELECT security_id, ticker FROM eligible_members WHERE security_id IN (SELECT security_id FROM history_ids)"),
)
def operational(spark, folder):
    return U.operational(fx.eligible_members(spark, folder), fx.history_ids(spark, folder)).select("security_id", "ticker")


MISSING = "SELECT security_id, ticker FROM eligible_members WHERE security_id NOT IN (SELECT security_id FROM history_ids)"


def _missing(spark, folder):
    return U.data_unavailable(fx.eligible_members(spark, folder), fx.history_ids(spark, folder)).select("security_id", "ticker")


@query(
    "data_unavailable",
    with_ctes("eligible_members history_ids lifecycle", f"{MISSING} AND security_id NOT IN (SELECT security_id FROM lifecycle)"),
)
def data_unavailable(spark, folder):
    members, ids = fx.eligible_members(spark, folder), fx.history_ids(spark, folder)
    return U.data_unavailable(members, ids, fx.lifecycle(spark, folder)).select("security_id", "ticker")


def _deferred(spark, folder):
    return fx.lifecycle(spark, folder).select("security_id", "reason", F.col("effective_date").alias("event_date"))


_PARTITION = """SELECT m.security_id, m.ticker, l.reason, l.effective_date AS event_date,
 CASE WHEN l.security_id IS NULL THEN 'RETRYABLE' ELSE 'DEFERRED_NO_RETRY' END AS status FROM missing m LEFT JOIN lifecycle l USING (security_id)"""


@query("partition_deferred", with_ctes("eligible_members history_ids lifecycle", _PARTITION, missing=MISSING))
def partition_deferred(spark, folder):
    return U.partition_deferred(_missing(spark, folder), _deferred(spark, folder))


@query(
    "new_member_gate",
    with_ctes(
        "eligible_members history_ids lifecycle",
        """SELECT count(*) FILTER (WHERE status = 'RETRYABLE') AS retryable, count(*) FILTER (WHERE status <> 'RETRYABLE') AS deferred,
 count(*) FILTER (WHERE status = 'RETRYABLE') <= 5 AS allowed FROM parts""",
        missing=MISSING,
        parts=_PARTITION,
    ),
)
def new_member_gate(spark, folder):
    return U.new_member_gate(U.partition_deferred(_missing(spark, folder), _deferred(spark, folder)), 5)


@query(
    "review_plan",
    with_ctes(
        "members members_later",
        """SELECT m.security_id, m.ticker, CASE WHEN l.sharia_compliance = 'COMPLIANT' THEN 'selected' ELSE 'excluded' END AS plan_status
 FROM members m LEFT JOIN members_later l USING (security_id)""",
    ),
)
def review_plan(spark, folder):
    candidates = fx.members(spark, folder).select("security_id", "ticker")
    return U.review_plan(candidates, fx.members(spark, folder, later=True))


@query(
    "review_plan_violations",
    with_ctes(
        "members lifecycle",
        """SELECT NULL AS security_id, 'snapshot_changed' AS violation UNION ALL
 SELECT security_id, 'candidate_also_deferred' FROM members WHERE security_id IN (SELECT security_id FROM lifecycle)""",
    ),
)
def review_plan_violations(spark, folder):
    members = fx.members(spark, folder)
    return U.review_plan_violations(members, fx.lifecycle(spark, folder), members, "2001-08-28", "2001-09-18")


RUN_RESULTS = """SELECT 'C' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS security_id, 'T' || CAST(o_custkey AS VARCHAR) AS ticker,
 'Y' || CAST(o_custkey AS VARCHAR) AS symbol, CASE WHEN o_orderpriority = '5-LOW' THEN 'repair-run-' ELSE 'run-' END || strftime(o_orderdate, '%Y-%m') AS manifest_key,
 o_orderkey AS pos, CASE WHEN o_orderstatus = 'F' THEN 'failed' WHEN o_orderstatus = 'P' THEN 'still_unavailable' ELSE 'uploaded' END AS status,
 'error ' || CAST(o_orderkey AS VARCHAR) AS error FROM orders"""


def run_results(spark, folder):
    """Results of acquisition runs, one per order, in monthly manifests."""
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    status = (
        F.when(F.col("o_orderstatus") == "F", "failed")
        .when(F.col("o_orderstatus") == "P", "still_unavailable")
        .otherwise("uploaded")
    )
    kind = F.when(F.col("o_orderpriority") == "5-LOW", "repair-run-").otherwise("run-")
    return fx.table(spark, folder, "orders").select(
        fx.padded("o_custkey", "C").alias("security_id"),
        text("T", "o_custkey").alias("ticker"),
        text("Y", "o_custkey").alias("symbol"),
        F.concat(kind, F.date_format("o_orderdate", "yyyy-MM")).alias("manifest_key"),
        F.col("o_orderkey").alias("pos"),
        status.alias("status"),
        text("error ", "o_orderkey").alias("error"),
    )


FAILURES = """SELECT security_id, f.ticker AS ticker, f.symbol AS symbol, f.error AS error, f.manifest_key AS manifest_key, still_unavailable, failures FROM
 (SELECT security_id, arg_max({'ticker': ticker, 'symbol': symbol, 'error': error, 'manifest_key': manifest_key}, manifest_key || lpad(CAST(pos AS VARCHAR), 12, '0')) FILTER (WHERE status = 'failed') AS f,
  bool_or(status = 'still_unavailable' AND starts_with(manifest_key, 'repair-run-')) AS still_unavailable, count(*) FILTER (WHERE status = 'failed') AS failures
  FROM results GROUP BY 1) WHERE failures > 0 OR still_unavailable"""


def failure_log(spark, folder):
    from barflow.sources.readers import latest_failure_log

    return latest_failure_log(run_results(spark, folder))


@query("latest_failure_log", with_ctes("", FAILURES, results=RUN_RESULTS))
def latest_failure_log(spark, folder):
    return failure_log(spark, folder)


def _queue(spark, folder):
    """Customers without a balance above zero count as missing."""
    c = fx.table(spark, folder, "customer")
    missing = c.filter(F.col("c_acctbal") <= 3000).select(
        fx.padded("c_custkey", "C").alias("security_id"), F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker")
    )
    known = c.filter((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)).select(
        fx.padded("c_custkey", "C").alias("security_id"), F.lower("c_name").alias("reason")
    )
    log = failure_log(spark, folder)
    return U.repair_queue(missing, known, log.filter(F.col("failures") > 0), log.filter("still_unavailable"))


_QUEUE = """SELECT m.security_id, m.ticker, f.symbol, CASE WHEN k.reason IS NOT NULL THEN 'delisted_or_merger'
 WHEN u.security_id IS NOT NULL THEN 'persistent_unavailable' ELSE 'retry_required' END AS category,
 coalesce(f.error, 'no failed record found') AS error, k.reason AS known_reason, f.manifest_key
 FROM (SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS security_id, 'T' || CAST(c_custkey AS VARCHAR) AS ticker FROM customer WHERE c_acctbal <= 3000) m
 LEFT JOIN (SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS security_id, lower(c_name) AS reason FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal < 0) k USING (security_id)
 LEFT JOIN (SELECT * FROM failures WHERE failures > 0) f ON m.security_id = f.security_id
 LEFT JOIN (SELECT security_id FROM failures WHERE still_unavailable) u ON m.security_id = u.security_id"""


@query("repair_queue", with_ctes("", _QUEUE, results=RUN_RESULTS, failures=FAILURES))
def repair_queue(spark, folder):
    return _queue(spark, folder)


@query(
    "retry_subset",
    with_ctes(
        "securities",
        """SELECT security_id, ticker, category FROM queue WHERE category = 'retry_required'
 AND security_id IN (SELECT security_id FROM securities WHERE sharia_compliance = 'COMPLIANT')""",
        results=RUN_RESULTS, failures=FAILURES, queue=_QUEUE,
    ),
)
def retry_subset(spark, folder):
    members = U.eligible(fx.securities(spark, folder))
    return U.retry_subset(_queue(spark, folder), members).select("security_id", "ticker", "category")


@query(
    "repair_counts",
    with_ctes("", "SELECT category, count(*) AS securities FROM queue GROUP BY 1", results=RUN_RESULTS, failures=FAILURES, queue=_QUEUE),
)
def repair_counts(spark, folder):
    return U.repair_counts(_queue(spark, folder))


@query(
    "added_subset",
    with_ctes(
        "members members_later history_ids",
        """SELECT security_id, ticker FROM members_later WHERE sharia_compliance = 'COMPLIANT' AND security_id NOT IN (SELECT security_id FROM history_ids)
 AND security_id NOT IN (SELECT security_id FROM members WHERE sharia_compliance = 'COMPLIANT')""",
    ),
)
def added_subset(spark, folder):
    later = U.eligible(fx.members(spark, folder, later=True))
    changes = S.membership_diff(fx.eligible_members(spark, folder), later)
    return U.added_subset(changes, later, fx.history_ids(spark, folder)).select("security_id", "ticker")


@query(
    "removed_securities",
    with_ctes("members history_ids", "SELECT security_id FROM members WHERE security_id NOT IN (SELECT security_id FROM history_ids)"),
)
def removed_securities(spark, folder):
    return S.removed_securities(fx.members(spark, folder), fx.history_ids(spark, folder))


@query(
    "membership_diff",
    with_ctes(
        "members members_later",
        """SELECT coalesce(o.security_id, n.security_id) AS security_id, CASE WHEN o.security_id IS NULL THEN 'added'
 WHEN n.security_id IS NULL THEN 'removed' ELSE 'ticker_change' END AS change_type, o.ticker AS old_ticker, n.ticker AS new_ticker
 FROM (SELECT * FROM members WHERE sharia_compliance = 'COMPLIANT') o
 FULL JOIN (SELECT * FROM members_later WHERE sharia_compliance = 'COMPLIANT') n ON o.security_id = n.security_id
 WHERE o.security_id IS NULL OR n.security_id IS NULL OR o.ticker <> n.ticker""",
    ),
)
def membership_diff(spark, folder):
    return S.membership_diff(fx.eligible_members(spark, folder), U.eligible(fx.members(spark, folder, later=True)))


@query(
    "set_algebra",
    with_ctes(
        "eligible_members history_ids",
        """SELECT coalesce(a.security_id, b.security_id) AS security_id, CASE WHEN a.security_id IS NULL THEN 'right_only'
 WHEN b.security_id IS NULL THEN 'left_only' ELSE 'both' END AS side
 FROM eligible_members a FULL JOIN history_ids b ON a.security_id = b.security_id""",
    ),
)
def set_algebra(spark, folder):
    return M.set_algebra(fx.eligible_members(spark, folder), fx.history_ids(spark, folder))


def _stages(spark, folder):
    """History, rolling, READY and an older reference of the same members."""
    # the stages compare keys alone; the ticker decides between bars of one date
    bars = clustered(fx.bars(spark, folder).select(*BAR_KEY, "ticker"), "bars")
    history = bars.join(fx.history_ids(spark, folder), "security_id", "left_semi")
    rolling = clustered(W.rolling_tail(bars.filter(F.col("date") <= date(2001, 11, 2))).select(*BAR_KEY), "rolling")
    ready = rolling.filter(F.col("date") <= date(2001, 10, 31))
    reference = bars.filter(F.col("date") <= date(2001, 10, 30))
    declared = B.readiness_detail(spark, folder, bars).filter(F.col("status") == "ready")
    rows = S.stage_reconcile(fx.eligible_members(spark, folder), history, rolling, ready, reference, declared)
    return S.freshness_flags(S.peer_lag(rows), 530)


_STAGE = """SELECT m.security_id, m.ticker, m.exchange, CASE WHEN h.n IS NULL THEN 'missing_history' ELSE 'available' END AS history_status,
 coalesce(h.n, 0) AS history_rows, h.a AS history_first_date, h.d AS history_last_date, coalesce(r.n, 0) AS rolling_rows, r.d AS rolling_last_date,
 y.n IS NOT NULL AS in_ready, coalesce(y.n, 0) AS ready_rows, y.d AS ready_last_date, d.security_id IS NOT NULL AS declared_ready,
 f.d AS reference_last_date, y.d > f.d AS advanced_since_reference, CASE WHEN h.n IS NULL THEN coalesce(r.n, 0) ELSE 0 END AS rolling_dates_absent_from_history
 FROM eligible_members m
 LEFT JOIN (SELECT security_id, count(*) AS n, min(date) AS a, max(date) AS d FROM bars WHERE security_id IN (SELECT security_id FROM history_ids) GROUP BY 1) h ON m.security_id = h.security_id
 LEFT JOIN (SELECT security_id, count(*) AS n, max(date) AS d FROM rolling GROUP BY 1) r ON m.security_id = r.security_id
 LEFT JOIN (SELECT security_id, count(*) AS n, max(date) AS d FROM rolling WHERE date <= DATE '2001-10-31' GROUP BY 1) y ON m.security_id = y.security_id
 LEFT JOIN (SELECT security_id FROM detail WHERE status = 'ready') d ON m.security_id = d.security_id
 LEFT JOIN (SELECT security_id, max(date) AS d FROM bars WHERE date <= DATE '2001-10-30' GROUP BY 1) f ON m.security_id = f.security_id"""
_ROLLING = "SELECT * FROM bars WHERE date <= DATE '2001-11-02' QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 300"
_FLAGS = """SELECT *, array_to_string(list_filter([CASE WHEN history_status <> 'available' THEN history_status END,
 CASE WHEN history_status = 'available' AND history_rows < 530 THEN 'insufficient_history' END,
 CASE WHEN history_status = 'available' AND history_last_date < peer_date THEN 'behind_exchange_peers_calendar_unverified' END,
 CASE WHEN history_status = 'available' AND rolling_last_date IS DISTINCT FROM history_last_date THEN 'history_rolling_date_mismatch' END,
 CASE WHEN in_ready AND ready_last_date IS DISTINCT FROM rolling_last_date THEN 'rolling_ready_date_mismatch' END,
 CASE WHEN in_ready <> declared_ready THEN 'readiness_export_membership_mismatch' END,
 CASE WHEN rolling_dates_absent_from_history > 0 THEN 'rolling_dates_absent_from_history' END], lambda x: x IS NOT NULL), '|') AS flags
 FROM (SELECT *, max(history_last_date) OVER (PARTITION BY exchange) AS peer_date FROM stage)"""
_STAGE_CTES = dict(detail=B.READINESS, rolling=_ROLLING, stage=_STAGE)
_STAGE_BASE = "bars eligible_members lifecycle history_ids"


@query("stage_reconcile", with_ctes(_STAGE_BASE, "SELECT * FROM stage", **_STAGE_CTES))
def stage_reconcile(spark, folder):
    return _stages(spark, folder).drop("flags", "peer_date", "history_date_problems")


@query("freshness_flags", with_ctes(_STAGE_BASE, "SELECT security_id, flags FROM flagged", **_STAGE_CTES, flagged=_FLAGS))
def freshness_flags(spark, folder):
    return _stages(spark, folder).select("security_id", X.joined(F.col("flags")).alias("flags"))


@query(
    "peer_lag",
    with_ctes(
        _STAGE_BASE,
        "SELECT security_id, exchange, history_last_date, max(history_last_date) OVER (PARTITION BY exchange) AS peer_date FROM stage",
        **_STAGE_CTES,
    ),
)
def peer_lag(spark, folder):
    return _stages(spark, folder).select("security_id", "exchange", "history_last_date", "peer_date")


@query(
    "flag_counts",
    with_ctes(
        _STAGE_BASE,
        "SELECT flag, count(*) AS securities FROM (SELECT unnest(string_split(flags, '|')) AS flag FROM flagged WHERE flags <> '') GROUP BY 1",
        **_STAGE_CTES,
        flagged=_FLAGS,
    ),
)
def flag_counts(spark, folder):
    return S.flag_counts(_stages(spark, folder))


# --- screening freshness
SNAPSHOT, AS_OF = date(2001, 4, 1), date(2001, 7, 15)
_E = "try_cast(substring(trim(next_earnings_date), 1, 10) AS DATE)"
_UPD = "greatest(try_cast(substring(updated_at, 1, 10) AS DATE), try_cast(substring(updated_date, 1, 10) AS DATE))"
_STATUS = f"""CASE WHEN {_E} IS NULL THEN 'UNKNOWN' WHEN {_E} > DATE '{AS_OF}' THEN 'AWAITING_NEXT_EARNINGS' WHEN {_E} = DATE '{AS_OF}' THEN 'UNKNOWN'
 WHEN {_E} >= DATE '{SNAPSHOT}' THEN 'POTENTIALLY_STALE' WHEN {_UPD} < {_E} THEN 'POTENTIALLY_STALE' ELSE 'UNKNOWN' END"""

_REASON = f"""CASE WHEN {_E} IS NULL THEN 'no_usable_earnings_date' WHEN {_E} > DATE '{AS_OF}' THEN 'earnings_date_ahead' WHEN {_E} = DATE '{AS_OF}' THEN 'earnings_date_today'
 WHEN {_E} >= DATE '{SNAPSHOT}' THEN 'earnings_since_snapshot' WHEN {_UPD} < {_E} THEN 'earnings_after_updates' ELSE 'updates_prove_nothing' END"""
_FRESH = f"{_STATUS} AS freshness_status, {_REASON} AS freshness_reason"


@query("screening_freshness", with_ctes("earnings", f"SELECT security_id, next_earnings_date, {_FRESH} FROM earnings"))
def screening_freshness(spark, folder):
    out = U.screening_freshness(fx.earnings(spark, folder), SNAPSHOT, AS_OF)
    return out.select("security_id", "next_earnings_date", "freshness_status", "freshness_reason")


def _screening(spark, folder):
    """Screened customers with a positive balance are in the master."""
    rich = fx.fundamentals(spark, folder).select("security_id")
    master = fx.earnings(spark, folder).join(rich, "security_id", "left_semi")
    return U.screening_report(U.eligible(fx.securities(spark, folder)), master, SNAPSHOT, AS_OF)


_REPORT = f"""SELECT s.security_id, s.ticker, e.next_earnings_date, e.updated_at, e.updated_date, {_FRESH}, e.security_id IS NOT NULL AS in_master
 FROM securities s LEFT JOIN (SELECT * FROM earnings WHERE security_id IN (SELECT security_id FROM fundamentals)) e USING (security_id) WHERE s.sharia_compliance = 'COMPLIANT'"""


@query("screening_report", with_ctes("securities earnings fundamentals", f"SELECT * FROM ({_REPORT})"))
def screening_report(spark, folder):
    return _screening(spark, folder)


_COUNTS = """SELECT count(*) AS securities_audited, CAST(0 AS BIGINT) AS post_earnings_refreshed, count(*) FILTER (WHERE freshness_status = 'AWAITING_NEXT_EARNINGS') AS awaiting_next_earnings,
 count(*) FILTER (WHERE freshness_status = 'POTENTIALLY_STALE') AS potentially_stale, count(*) FILTER (WHERE freshness_status = 'UNKNOWN') AS unknown FROM report"""


@query("screening_counts", with_ctes("securities earnings fundamentals", _COUNTS, report=_REPORT))
def screening_counts(spark, folder):
    return U.screening_counts(_screening(spark, folder))


def _updates(spark, folder):
    """Update outcomes of the lifecycle-listed securities that have history."""
    gone = F.col("lifecycle_status").startswith("VERIFIED")
    status = F.when(gone, "lifecycle_excluded").otherwise("stale_after_failure")
    return fx.lifecycle(spark, folder).join(fx.history_ids(spark, folder), "security_id", "left_semi").select(
        "security_id", status.alias("update_status")
    )


def _review(spark, folder):
    detail = B.readiness_detail(spark, folder)
    fresh = _member_screening(spark, folder)
    return U.review_queue(
        fresh, detail, fx.members(spark, folder), _updates(spark, folder), B.READY_MINIMUM, B.READY_TARGET
    )


def _member_screening(spark, folder):
    """The members' screening rows, their dates taken from customers of the same number."""
    master = fx.earnings(spark, folder).withColumn(
        "security_id", F.concat(F.lit("S"), F.substring("security_id", 2, 10))
    )
    return U.screening_report(fx.eligible_members(spark, folder), master, SNAPSHOT, AS_OF)


_MEMBER_REPORT = f"""SELECT m.security_id, m.ticker, e.next_earnings_date, coalesce(e.updated_at, e.updated_date) AS updated, {_FRESH} FROM eligible_members m
 LEFT JOIN (SELECT 'S' || substring(security_id, 2, 10) AS security_id, next_earnings_date, updated_at, updated_date FROM earnings) e USING (security_id)"""
_REVIEW = f"""SELECT security_id, ticker, category, reason, recorded_earnings_date, last_market_date, screening_updated_at FROM (
 SELECT security_id, ticker, CASE status WHEN 'insufficient' THEN 'INSUFFICIENT_HISTORY' WHEN 'unavailable' THEN 'DATA_UNAVAILABLE' ELSE 'REVIEWED_NO_RETRY' END AS category,
  CASE status WHEN 'insufficient' THEN CAST(rolling_bars AS VARCHAR) || ' of {B.READY_MINIMUM} minimum bars ({B.READY_TARGET} target)' WHEN 'unavailable' THEN 'No historical OHLCV data available' END AS reason,
  CAST(NULL AS VARCHAR) AS recorded_earnings_date, CASE WHEN status = 'insufficient' THEN last_date END AS last_market_date, CAST(NULL AS VARCHAR) AS screening_updated_at FROM detail WHERE status <> 'ready'
 UNION ALL SELECT security_id, ticker, freshness_status, freshness_reason, next_earnings_date, NULL, updated FROM report WHERE freshness_status IN ('POTENTIALLY_STALE', 'UNKNOWN')
 UNION ALL SELECT l.security_id, m.ticker, CASE WHEN starts_with(lifecycle_status, 'VERIFIED') THEN 'LIFECYCLE_EXCLUDED' ELSE 'DAILY_UPDATE_FAILED' END,
  CASE WHEN starts_with(lifecycle_status, 'VERIFIED') THEN 'Verified lifecycle state; daily acquisition skipped' ELSE 'Daily update failed; data held at last known state' END, NULL, d.last_date, NULL
  FROM lifecycle l JOIN history_ids USING (security_id) JOIN members m ON m.security_id = l.security_id LEFT JOIN detail d ON d.security_id = l.security_id)"""
_REVIEW_BASE = "bars members eligible_members lifecycle history_ids earnings"
_REVIEW_CTES = dict(detail=B.READINESS, report=_MEMBER_REPORT, review=_REVIEW)


@query("review_queue", with_ctes(_REVIEW_BASE, "SELECT * FROM review", **_REVIEW_CTES))
def review_queue(spark, folder):
    return U.queue_order(_review(spark, folder))


def _registry(spark, folder):
    """Reviews recorded for the lifecycle-listed members."""
    names = fx.members(spark, folder).select("security_id", "ticker")
    return fx.lifecycle(spark, folder).join(names, "security_id").select(
        "security_id", "ticker", F.lit("market_data").alias("scope"),
        F.when(F.col("lifecycle_status") == "REVIEW_REQUIRED", "2001-03-01").otherwise("2001-04-01").alias("snapshot_date"),
        F.when(F.col("effective_date").isNotNull(), "2001-04-02").alias("reviewed_at"),
        F.col("reason").alias("finding"), F.concat(F.lit("https://example.org/"), "ticker").alias("source_url"),
        F.lit("FOLLOW_UP_REQUIRED").alias("resolution"),
    )


_REGISTRY = """SELECT l.security_id, m.ticker, 'market_data' AS scope, CASE WHEN lifecycle_status = 'REVIEW_REQUIRED' THEN '2001-03-01' ELSE '2001-04-01' END AS snapshot_date,
 CASE WHEN effective_date IS NOT NULL THEN '2001-04-02' END AS reviewed_at, reason AS finding, 'https://example.org/' || m.ticker AS source_url
 FROM lifecycle l JOIN members m USING (security_id)"""


@query(
    "attach_reviews",
    with_ctes(
        _REVIEW_BASE,
        """SELECT q.security_id, q.ticker, q.category, q.scope, q.reason, q.recorded_earnings_date, q.last_market_date, q.screening_updated_at, CASE WHEN r.security_id IS NULL THEN 'DETECTED_ONLY' ELSE 'REVIEWED_FOLLOW_UP_REQUIRED' END AS review_status,
 r.reviewed_at, r.finding, r.source_url FROM (SELECT *, CASE WHEN category IN ('DATA_UNAVAILABLE', 'INSUFFICIENT_HISTORY', 'DAILY_UPDATE_FAILED') THEN 'market_data' ELSE 'screening' END AS scope FROM review) q
 LEFT JOIN (SELECT * FROM registry WHERE snapshot_date = '2001-04-01') r ON q.security_id = r.security_id AND q.ticker = r.ticker AND q.scope = r.scope""",
        **_REVIEW_CTES,
        registry=_REGISTRY,
    ),
)
def attach_reviews(spark, folder):
    return U.attach_reviews(_review(spark, folder), _registry(spark, folder), "2001-04-01")


@query(
    "review_registry_issues",
    with_ctes(
        "members lifecycle",
        "SELECT security_id, ticker, scope, snapshot_date, 'evidence_missing' AS issue FROM registry WHERE reviewed_at IS NULL",
        registry=_REGISTRY,
    ),
)
def review_registry_issues(spark, folder):
    return U.review_registry_issues(_registry(spark, folder))


@query(
    "status_summary",
    with_ctes(
        _REVIEW_BASE + " members_later",
        """SELECT s.*, ch.*, pc.post_earnings_refreshed, pc.awaiting_next_earnings, pc.potentially_stale, pc.unknown, uf.n AS update_failures,
 pc.awaiting_next_earnings + pc.potentially_stale + pc.unknown = s.confirmed_compliant AS coverage_ok, CASE WHEN uf.n > 0 THEN 'DEGRADED' ELSE 'OPERATIONAL' END AS pipeline_status
 FROM summary s, counts pc, (SELECT count(*) AS n FROM lifecycle WHERE lifecycle_status = 'REVIEW_REQUIRED' AND security_id IN (SELECT security_id FROM history_ids)) uf,
 (SELECT count(*) FILTER (WHERE o.security_id IS NULL) AS added, count(*) FILTER (WHERE n.security_id IS NULL) AS removed, count(*) FILTER (WHERE o.ticker <> n.ticker) AS ticker_changes
  FROM (SELECT * FROM members WHERE sharia_compliance = 'COMPLIANT') o FULL JOIN (SELECT * FROM members_later WHERE sharia_compliance = 'COMPLIANT') n ON o.security_id = n.security_id) ch""",
        detail=B.READINESS,
        report=_MEMBER_REPORT,
        summary=B.SUMMARY,
        counts=_COUNTS,
    ),
)
def status_summary(spark, folder):
    changes = S.membership_diff(fx.eligible_members(spark, folder), U.eligible(fx.members(spark, folder, later=True)))
    failed = _updates(spark, folder).filter(F.col("update_status") == "stale_after_failure")
    return U.status_summary(
        W.readiness_summary(B.readiness_detail(spark, folder)),
        changes,
        U.screening_counts(_member_screening(spark, folder)),
        failed,
    )


# --- explorer and inventory
def explorer(spark, folder):
    return P.explorer_view(fx.securities(spark, folder), fx.fundamentals(spark, folder))


@query("explorer_view", with_ctes("explorer", "SELECT * FROM explorer"))
def explorer_view(spark, folder):
    return explorer(spark, folder)


REQUEST = P.ExplorerRequest(
    q="customer#0",
    compliance="compliant",
    minimums={"eps_yoy_latest": 2.0},
    maximums={"annual_eps_growth": 9.5},
    sort="revenue_yoy_latest",
    page=2,
    limit=25,
)
_WHERE = """sharia_compliance = 'COMPLIANT' AND (ticker ILIKE 'CUSTOMER#0%' OR company_name ILIKE '%customer#0%')
 AND eps_yoy_latest >= 2.0 AND annual_eps_growth <= 9.5"""


@query(
    "explorer_query",
    with_ctes(
        "explorer",
        f"""SELECT *, (SELECT count(*) FROM explorer WHERE {_WHERE}) AS total, 2 AS page, 25 AS "limit", 'revenue_yoy_latest' AS sort, 'asc' AS "order" FROM explorer WHERE {_WHERE}
 ORDER BY revenue_yoy_latest NULLS FIRST, ticker, security_id LIMIT 25 OFFSET 25""",
    ),
)
def explorer_query(spark, folder):
    return P.explorer_query(explorer(spark, folder), REQUEST)


@query(
    "prefix_rollup",
    with_ctes(
        "inventory",
        """SELECT array_to_string(list_slice(dir, 1, depth), '/') AS path, CAST(depth AS INTEGER) AS depth, count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes
 FROM (SELECT dir, size, unnest(generate_series(1, len(dir))) AS depth FROM
  (SELECT list_filter(string_split(key, '/'), lambda x: x <> '')[:-2] AS dir, size FROM inventory)) GROUP BY 1, 2""",
    ),
)
def prefix_rollup(spark, folder):
    return P.prefix_rollup(fx.inventory(spark, folder))


@query(
    "prefix_rollup_top",
    with_ctes(
        "inventory",
        """SELECT p[1] || CASE WHEN len(p) > 1 THEN '/' ELSE '' END AS prefix, count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes
 FROM (SELECT string_split(key, '/') AS p, size FROM inventory) GROUP BY 1""",
    ),
)
def prefix_rollup_top(spark, folder):
    return P.largest_first(P.prefix_rollup(fx.inventory(spark, folder), depth=1))


@query(
    "inventory_totals",
    with_ctes(
        "inventory",
        """SELECT count(*) AS total_objects, CAST(sum(size) AS BIGINT) AS total_bytes, count(*) FILTER (WHERE starts_with(key, 'm.')) AS protected_objects,
 CAST(coalesce(sum(size) FILTER (WHERE starts_with(key, 'm.')), 0) AS BIGINT) AS protected_bytes FROM inventory""",
    ),
)
def inventory_totals(spark, folder):
    return P.inventory_totals(fx.inventory(spark, folder), ("m.",))


def directory(spark, folder):
    """Parts as listed symbols; flags in the spellings found in the field."""
    return fx.table(spark, folder, "part").select(
        F.expr("CASE WHEN p_partkey % 50 = 0 THEN '  ' ELSE concat(' p', cast(p_partkey as string)) END").alias("symbol"),
        F.expr("CASE WHEN p_size < 5 THEN 'Y' WHEN p_size < 8 THEN ' yes' WHEN p_size > 45 THEN NULL ELSE 'N' END").alias("is_etf"),
        F.expr("CASE WHEN p_type = 'SMALL' AND p_size > 40 THEN '1' ELSE 'N' END").alias("test_issue"),
    )


_SYMBOLS = """SELECT DISTINCT 'P' || CAST(p_partkey AS VARCHAR) AS symbol FROM part WHERE p_partkey % 50 <> 0 AND p_size >= 8 AND NOT (p_type = 'SMALL' AND p_size > 40)"""


@query("universe_symbols", _SYMBOLS)
def universe_symbols(spark, folder):
    return R.universe_symbols(directory(spark, folder))


@query(
    "hash_sample",
    f"SELECT symbol, sha256('run-1|' || symbol) AS sample_rank FROM ({_SYMBOLS}) ORDER BY 2 LIMIT 100",
)
def hash_sample(spark, folder):
    return R.hash_sample(R.universe_symbols(directory(spark, folder)), 100, "run-1")
