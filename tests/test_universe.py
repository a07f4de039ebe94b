import pytest
from conftest import day, rows_of

from barflow.operators import explorer as P
from barflow.operators import universe as U
from barflow.schemas import ContractError


def ids(spark, text):
    return spark.createDataFrame([(c, f"T{c}") for c in text], "security_id string, ticker string")


def test_eligibility_is_exact(spark):
    rows = [("A", "a", "COMPLIANT"), ("B", "b", "compliant"), ("C", "c", None), ("D", "d", "DOUBTFUL"), ("", "e", "COMPLIANT"), ("F", None, "COMPLIANT")]
    df = spark.createDataFrame(rows, "security_id string, ticker string, sharia_compliance string")
    assert rows_of(U.eligible(df), "security_id") == [("A",)]


def test_missing_members_and_deferral_by_id(spark):
    members, history = ids(spark, "ABCD"), ids(spark, "AB")
    assert rows_of(U.operational(members, history), "security_id") == [("A",), ("B",)]
    missing = U.data_unavailable(members, history)
    assert rows_of(U.data_unavailable(members, history, ids(spark, "C")), "security_id") == [("D",)]
    # the deferred entry carries another member's ticker; only its id counts
    deferred = spark.createDataFrame([("C", "TD", "merged", None)], "security_id string, ticker string, reason string, event_date string")
    parts = U.partition_deferred(missing, deferred)
    assert rows_of(parts, "security_id", "status", "reason") == [("C", "DEFERRED_NO_RETRY", "merged"), ("D", "RETRYABLE", None)]
    assert tuple(U.new_member_gate(parts, 0).first()) == (1, 1, False)
    bad = spark.createDataFrame([("C",), ("C",), (" ",)], "security_id string")
    assert rows_of(U.deferred_issues(bad), "issue") == [("duplicate_security_id",), ("missing_security_id",)]


def test_review_plan(spark):
    members = spark.createDataFrame([("A", "COMPLIANT"), ("B", "DOUBTFUL")], "security_id string, sharia_compliance string")
    plan = U.review_plan(ids(spark, "ABC"), members)
    assert rows_of(plan, "security_id", "plan_status") == [("A", "selected"), ("B", "excluded"), ("C", "excluded")]
    check = lambda c, d, m, n=None, s="x": rows_of(U.review_plan_violations(c, d, m, "x", s, n), "violation")
    assert check(ids(spark, "AB"), ids(spark, "C"), ids(spark, "AB"), 2) == []
    assert check(ids(spark, "AA"), ids(spark, "A"), ids(spark, "BB"), 5, "y") == [
        ("candidate_also_deferred",), ("duplicate_candidate",), ("duplicate_membership_id",), ("membership_count_mismatch",), ("snapshot_changed",),
    ]


def test_repair_queue_categories(spark):
    known = spark.createDataFrame([("A", "merged")], "security_id string, reason string")
    failures = spark.createDataFrame([("B", "Y", "timeout", "run-1")], "security_id string, symbol string, error string, manifest_key string")
    queue = U.repair_queue(ids(spark, "ABCD"), known, failures, ids(spark, "AC"))
    assert rows_of(queue, "security_id", "category", "error") == [
        ("A", "delisted_or_merger", "no failed record found"), ("B", "retry_required", "timeout"),
        ("C", "persistent_unavailable", "no failed record found"), ("D", "retry_required", "no failed record found"),
    ]
    assert rows_of(U.retry_subset(queue, ids(spark, "BC")), "security_id") == [("B",)]


@pytest.mark.parametrize(
    "earnings, updated_at, updated_date, status",
    [
        ("2026-09-20", None, None, "AWAITING_NEXT_EARNINGS"),
        ("2026-09-15", None, None, "UNKNOWN"),
        ("2026-09-14T20:00:00Z", None, None, "POTENTIALLY_STALE"),
        ("2026-08-28", None, None, "POTENTIALLY_STALE"),
        ("2026-08-27", "2026-08-26T00:00:00", "2026-08-01", "POTENTIALLY_STALE"),
        ("2026-08-27", "2026-08-27", None, "UNKNOWN"),
        ("2026-08-27", None, "2026-08-26", "POTENTIALLY_STALE"),
        ("2026-08-27", None, "not a date", "UNKNOWN"),
        (None, None, None, "UNKNOWN"),
        ("  ", None, None, "UNKNOWN"),
        ("2026-02-30", None, None, "UNKNOWN"),
    ],
)
def test_screening_freshness(spark, earnings, updated_at, updated_date, status):
    df = spark.createDataFrame([(earnings, updated_at, updated_date)], "next_earnings_date string, updated_at string, updated_date string")
    assert U.screening_freshness(df, day("2026-08-28"), day("2026-09-15")).first()["freshness_status"] == status


def test_screening_report_counts(spark):
    master = spark.createDataFrame([("A", "2026-09-01", None, None)], "security_id string, next_earnings_date string, updated_at string, updated_date string")
    report = U.screening_report(ids(spark, "AB"), master, day("2026-08-28"), day("2026-09-15"))
    assert rows_of(report, "security_id", "freshness_status", "in_master") == [("A", "POTENTIALLY_STALE", True), ("B", "UNKNOWN", False)]
    row = U.screening_counts(report).first()
    assert (row["securities_audited"], row["post_earnings_refreshed"], row["potentially_stale"], row["unknown"]) == (2, 0, 1, 1)
    with pytest.raises(ContractError):
        U.screening_report(ids(spark, "A"), master, day("2026-09-16"), day("2026-09-15"))


def test_review_queue_reviews_and_status(spark):
    detail = spark.createDataFrame(
        [("A", None, 100, day("2024-01-02"), "insufficient"), ("B", "TB", 0, None, "unavailable"), ("C", "TC", 300, day("2024-01-03"), "ready"), ("D", "TD", 0, None, "reviewed_no_retry")],
        "security_id string, ticker string, rolling_bars long, last_date date, status string",
    )
    fresh = spark.createDataFrame(
        [("C", "TC", "UNKNOWN", "why", "x", None, "2024-01-01"), ("A", "TA", "AWAITING_NEXT_EARNINGS", "why", "y", None, None)],
        "security_id string, ticker string, freshness_status string, freshness_reason string, next_earnings_date string, updated_at string, updated_date string",
    )
    updates = spark.createDataFrame([("C", "stale_after_failure"), ("A", "lifecycle_excluded"), ("B", "updated")], "security_id string, update_status string")
    queue = U.review_queue(fresh, detail, ids(spark, "ABCD"), updates)
    ordered = [(r["category"], r["ticker"], r["security_id"]) for r in U.queue_order(queue).collect()]
    assert ordered == [
        ("DAILY_UPDATE_FAILED", "TC", "C"), ("DATA_UNAVAILABLE", "TB", "B"), ("INSUFFICIENT_HISTORY", "TA", "A"),
        ("LIFECYCLE_EXCLUDED", "TA", "A"), ("REVIEWED_NO_RETRY", "TD", "D"), ("UNKNOWN", "TC", "C"),
    ]
    assert queue.filter("category = 'INSUFFICIENT_HISTORY'").first()["reason"] == "100 of 250 minimum bars (300 target)"
    screened = queue.filter("category = 'UNKNOWN'").first()
    assert (screened["reason"], screened["screening_updated_at"]) == ("why", "2024-01-01")
    assert U.review_queue(None, detail, ids(spark, "ABCD")).count() == 3
    schema = "security_id string, ticker string, scope string, snapshot_date string, reviewed_at string, finding string, source_url string, resolution string"
    good = ("B", "TB", "market_data", "s1", "2024-01-05", "gone", "https://example.org/x", "FOLLOW_UP_REQUIRED")
    registry = spark.createDataFrame([good, ("C", "TC", "market_data", "s0", "d", "f", "https://e.org/", "FOLLOW_UP_REQUIRED")], schema)
    out = U.attach_reviews(queue, registry, "s1")
    assert rows_of(out.filter("review_status <> 'DETECTED_ONLY'"), "security_id", "category") == [("B", "DATA_UNAVAILABLE")]
    assert out.filter("category = 'UNKNOWN'").first()["scope"] == "screening"
    bad = [good, good, ("D", "TD", "market_data", "s1", "d", "f", "http://e.org/", "FOLLOW_UP_REQUIRED"), ("E", "TE", "screening", "s1", "d", "f", "https://e.org/", "FOLLOW_UP_REQUIRED")]
    assert rows_of(U.review_registry_issues(spark.createDataFrame(bad, schema)), "security_id", "issue") == [
        ("B", "duplicate_record"), ("D", "evidence_missing"), ("E", "unsupported_scope_or_resolution"),
    ]
    summary = spark.createDataFrame([(3,)], "confirmed_compliant long")
    changes = spark.createDataFrame([("A", "added"), ("B", "removed"), ("C", "added")], "security_id string, change_type string")
    counts = spark.createDataFrame([(0, 1, 1, 1)], "post_earnings_refreshed long, awaiting_next_earnings long, potentially_stale long, unknown long")
    row = U.status_summary(summary, changes, counts, updates.limit(0)).first()
    assert (row["added"], row["removed"], row["ticker_changes"], row["coverage_ok"], row["pipeline_status"]) == (2, 1, 0, True, "OPERATIONAL")
    row = U.status_summary(summary, changes, None, updates).first()
    assert (row["unknown"], row["coverage_ok"], row["pipeline_status"]) == (None, None, "DEGRADED")


@pytest.fixture
def view(spark):
    s = spark.createDataFrame(
        [(f"S{i:03d}", f"TK{i % 7}{i:03d}", f"Acme {i} Corp" if i % 2 else f"Zeta {i}", "COMPLIANT" if i % 3 else "DOUBTFUL", "2024-01-01") for i in range(250)],
        "security_id string, ticker string, company_name string, sharia_compliance string, universe_snapshot_date string",
    )
    f = spark.createDataFrame(
        [(f"S{i:03d}", "ok", "d", "d", "d", i / 10, None, None if i % 5 == 0 else float(i), None, i / 7) for i in range(200)],
        "security_id string, status string, as_of_date string, accepted_at string, fiscal_period_end string, eps_yoy_latest double,"
        " eps_yoy_prior double, revenue_yoy_latest double, revenue_yoy_prior double, annual_eps_growth double",
    )
    return P.explorer_view(s, f)


def test_explorer_filters_sort_and_pages(view):
    assert view.count() == 250 and view.filter("fundamental_status is null").count() == 50
    page = P.explorer_query(view, P.ExplorerRequest(q="acme", compliance="compliant", minimums={"eps_yoy_latest": 5.0}, sort="eps_yoy_latest", descending=True, limit=10, page=2)).collect()
    want = sorted((i for i in range(200) if i % 2 and i % 3 and i / 10 >= 5.0), reverse=True)
    assert [r["security_id"] for r in page] == [f"S{i:03d}" for i in want[10:20]]
    assert {r["total"] for r in page} == {len(want)}
    assert {(r["page"], r["limit"], r["sort"], r["order"]) for r in page} == {(2, 10, "eps_yoy_latest", "desc")}
    clamped = P.explorer_query(view, P.ExplorerRequest(sort="nothing", limit=999)).first()
    assert (clamped["limit"], clamped["sort"]) == (200, "ticker")
    assert P.explorer_query(view, P.ExplorerRequest(limit=999, max_limit=1000)).count() == 250
    assert P.explorer_matches(view, P.ExplorerRequest(q="ac\\me")).count() == 0
    nulls_first = P.explorer_query(view, P.ExplorerRequest(sort="revenue_yoy_latest", limit=5)).collect()
    assert all(r["revenue_yoy_latest"] is None for r in nulls_first)
    prefix = P.explorer_matches(view, P.ExplorerRequest(q="tk3"))
    assert prefix.count() == len([i for i in range(250) if i % 7 == 3])


@pytest.mark.parametrize("limit, size", [(None, 50), (0, 50), (-3, 1), (1000, 200), (7, 7)])
def test_explorer_page_bounds(limit, size):
    assert P.ExplorerRequest(limit=limit).page_size == size
    assert P.ExplorerRequest(sort="drop table", page=0).sort_column == "ticker"
    assert P.ExplorerRequest(page=-2).offset == 0


def test_prefix_rollup(spark):
    rows = [("a/b/c.txt", 5), ("a/b/d.txt", 7), ("a/e.txt", 1), ("root.txt", 100), ("//a//x.txt", 2)]
    df = spark.createDataFrame(rows, "key string, size long")
    assert rows_of(P.prefix_rollup(df), "path", "depth", "objects", "bytes") == [("a", 1, 4, 15), ("a/b", 2, 2, 12)]
    top = [tuple(r) for r in P.largest_first(P.prefix_rollup(df.limit(4), 1)).collect()]
    assert top == [("root.txt", 1, 100), ("a/", 3, 13)]
    assert rows_of(P.prefix_rollup(df.limit(4), 2)) == [("a/b/", 2, 12), ("a/e.txt/", 1, 1), ("root.txt", 1, 100)]
    assert tuple(P.inventory_totals(df, ("a/",)).first()) == (5, 115, 3, 13)
