import pytest
from conftest import bar, day, days, rows_of

from barflow.operators import continuity as C
from barflow.operators import windows as W


def test_terminal_summary_mode_tie_and_leading_edge(bars):
    tie = bars([bar("A", "2024-01-02"), bar("B", "2024-01-03"), bar("C", "2024-01-01"), bar("C", "2024-01-03"), bar("D", "2024-01-02")])
    row = C.terminal_summary(tie).first()
    assert (str(row["as_of_date"]), row["as_of_security_count"], row["verdict"]) == ("2024-01-03", 2, "coherent")
    edge = bars([bar("A", "2024-01-02"), bar("B", "2024-01-02"), bar("C", "2024-01-03")])
    row = C.terminal_summary(edge).first()
    assert (row["verdict"], row["terminal_date_histogram"]) == ("partial_leading_edge", "2024-01-02:2|2024-01-03:1")
    assert C.terminal_summary(edge.limit(0)).first()["verdict"] == "empty"


def test_session_gaps_skip_stale_and_invent_nothing(bars):
    full = [bar("A", d) for d in ("2024-01-04", "2024-01-05", "2024-01-08", "2024-01-09")]
    gapped = [bar("B", d) for d in ("2024-01-04", "2024-01-05", "2024-01-09")]
    stale = [bar("C", d) for d in ("2024-01-04", "2024-01-05")]
    df = bars(full + gapped + stale)
    gaps = C.session_gaps(df, day("2024-01-04"), day("2024-01-09"))
    assert rows_of(gaps) == [("B", day("2024-01-08"))]  # the weekend is no session
    assert rows_of(C.expected_sessions(df, day("2024-01-04"), day("2024-01-09"))) == [(day(d),) for d in ("2024-01-05", "2024-01-08", "2024-01-09")]
    assert rows_of(C.session_gap_summary(df, day("2024-01-04"), day("2024-01-09")), "gap_security_count", "missing_bars", "expected_sessions") == [(1, 1, 3)]
    assert C.session_gaps(df, day("2024-01-09"), day("2024-01-09")).count() == 0
    evidence = C.gap_evidence(gaps, bars(gapped + [bar("B", "2024-01-08", 7.0)]))
    assert rows_of(evidence, "in_history", "close", "history_rows") == [(True, 7.0, 4)]


def test_bracketed_gap_and_coverage(bars):
    df = bars([
        bar("A", "2024-01-01"), bar("A", "2024-01-03", ticker="NEW"), bar("B", "2024-01-01"), bar("B", "2024-01-02"), bar("B", "2024-01-03"),
        bar("C", "2024-01-03"),
    ])
    assert rows_of(C.bracketed_gap(df, day("2024-01-02"))) == [("A", "NEW")]
    members = df.select("security_id").distinct()
    assert tuple(C.session_coverage(members, df, day("2024-01-03"), 3).first()) == (3, 3, 0, True)
    assert tuple(C.session_coverage(members, df, day("2024-01-02"), 2).first()) == (3, 1, 2, False)


def test_quarantined_predecessor(spark):
    current = spark.createDataFrame([("2024-01-05", "f1"), ("2024-01-06", "f2"), ("2024-01-07", "f3")], "as_of_date string, fingerprint string")
    quarantine = spark.createDataFrame([("2024-01-05", "f1", "2024-01-03"), ("2024-01-06", "f2", None), ("2024-01-07", "other", "2024-01-01")], "as_of_date string, fingerprint string, last_known_good string")
    out = C.trusted_predecessor(current, quarantine)
    assert rows_of(out, "as_of_date", "previous_as_of", "verdict") == [
        ("2024-01-05", "2024-01-03", "usable"), ("2024-01-06", None, "quarantine_without_good_date"), ("2024-01-07", "2024-01-07", "usable"),
    ]


def test_readiness_statuses(bars, spark):
    history = bars([bar("A", d) for d in days("2024-01-01", 6)] + [bar("B", d) for d in days("2024-01-01", 2)])
    members = spark.createDataFrame([(s, f"T{s}") for s in "ABCD"], "security_id string, ticker string")
    reviewed = spark.createDataFrame([("D",), ("A",)], "security_id string")
    detail = W.readiness(members, history, reviewed, n=4, minimum=3)
    assert rows_of(detail, "security_id", "available_bars", "rolling_bars", "first_rolling_date", "status") == [
        ("A", 6, 4, day("2024-01-03"), "ready"), ("B", 2, 2, day("2024-01-01"), "insufficient"),
        ("C", 0, 0, None, "unavailable"), ("D", 0, 0, None, "reviewed_no_retry"),
    ]
    s = W.readiness_summary(detail).first()
    assert (s["ready"], s["insufficient_history"], s["data_unavailable"], s["reviewed_no_retry"], s["rolling_rows"]) == (1, 1, 1, 1, 6)
    with pytest.raises(ValueError):
        W.readiness(members, history, n=3, minimum=4)
    assert W.rolling_tail(history, 4).count() == 6


def test_ready_selection_violations(spark):
    ids = lambda text: spark.createDataFrame([(c,) for c in text], "security_id string")
    members = ids("ABCDE")
    clean = C.ready_selection(ids("AB"), members, ids("C"), 2, 5)
    assert clean.count() == 0
    bad = C.ready_selection(ids("AACX"), members, ids("C"), 3, 4)
    assert rows_of(bad) == sorted([
        (None, "eligibility_count_stale"), (None, "inconsistent_ready_ids"), ("X", "not_eligible"), ("C", "ready_and_excluded"),
    ], key=repr)
    assert rows_of(C.ready_selection(ids(""), members, ids("C"), 0, 5)) == [(None, "empty_ready_list")]


def test_ready_filter_violations(bars, spark):
    rolling = bars(
        [bar("A", d) for d in days("2024-01-01", 3)]
        + [bar("B", "2024-01-01")] * 3
        + [bar("C", "2024-01-01")]
        + [bar("D", d) for d in days("2024-01-01", 3)]
        + [bar("E", d, high=1.0) for d in days("2024-01-01", 3)]
    )
    details = spark.createDataFrame(
        [("A", 3, day("2024-01-03")), ("B", 3, day("2024-01-01")), ("C", 1, day("2024-01-01")), ("D", 2, day("2024-01-03")), ("E", 3, day("2024-01-03")), ("F", 3, None)],
        "security_id string, rolling_bars long, last_date date",
    )
    out = C.ready_filter_violations(rolling, details, details, 2, 4)
    assert dict(rows_of(out, "security_id", "violation")) == {
        "B": "null_or_duplicate_dates", "C": "row_count_outside_thresholds", "D": "disagrees_with_readiness",
        "E": "qc_rejected", "F": "no_rolling_data",
    }
    final = rolling.filter("date <= '2024-01-02'")
    assert rows_of(C.finalized_coverage_violations(final, details.filter("security_id in ('A', 'C')"), 2)) == [("C", 1)]


def test_rs20_needs_21_shared_bars(bars):
    d = days("2024-01-01", 22)
    bench = bars([bar("K", x, 100.0 + i) for i, x in enumerate(d)])
    stock = bars([bar("A", x, 50.0 + 2 * i) for i, x in enumerate(d)] + [bar("B", x) for x in d[2:]] + [bar("A", "2023-06-01")])
    aligned = W.common_calendar(stock, bench)
    out = {r["security_id"]: r for r in W.rs20(aligned).collect()}
    assert out["A"]["rs20"] == ((92.0 / 52.0 - 1) - (121.0 / 101.0 - 1)) * 100
    assert out["B"]["rs20"] is None and out["B"]["outcome"] == "fewer_than_21_shared_bars"
    series = W.rs20_series(aligned).filter("security_id = 'A' and rs20 is not null")
    assert series.count() == 2


def test_history_gate_reports_first_failure(bars, spark):
    d = days("2024-01-01", 25)
    bench = bars([bar("K", x) for x in d])
    rows = []
    for sid in "ABCDEF":
        rows += [bar(sid, x) for x in d[: 20 if sid == "F" else 25]]
    rows = [r | ({"high": 1.0} if r["security_id"] == "B" and r["date"] == d[3] else {}) for r in rows]
    rows = [r | ({"ticker": "ZZ"} if r["security_id"] == "C" and r["date"] == d[3] else {}) for r in rows]
    rows += [bar("D", d[0])]
    # two different adjustment failures: the factor is reported, being checked first
    rows += [bar("H", x, adj_close=1e308 if i == 3 else 10.0, close=1e-5 if i == 3 else 10.0, low=1e-6 if i == 3 else 9.0) for i, x in enumerate(d)]
    expected = spark.createDataFrame([(s, f"T{s}") for s in "ABCDFGH"], "security_id string, ticker string")
    out = W.history_gate(bars(rows), bench, expected)
    assert dict(rows_of(out, "security_id", "error")) == {
        "A": None, "B": "qc_rejected", "C": "identity_mismatch", "D": "invalid_duplicate_or_unordered_dates",
        "F": "fewer_than_21_shared_bars", "G": "no_history",
        "H": "invalid_adjustment_factor",
    }


def test_tail_counts_dates_not_rows(bars):
    df = bars([bar("A", "2024-01-01"), bar("A", "2024-01-02", 1.0), bar("A", "2024-01-02", 2.0), bar("A", "2024-01-03")])
    assert rows_of(W.rolling_tail(df, 3), "date", "close") == [(day("2024-01-01"), 10.0), (day("2024-01-02"), 2.0), (day("2024-01-03"), 10.0)]
    first = df.withColumn("n", -df["close"])
    assert rows_of(W.rolling_tail(first, 2, "n"), "date", "close") == [(day("2024-01-02"), 1.0), (day("2024-01-03"), 10.0)]


def test_repeated_history_does_not_multiply_gaps(bars, spark):
    gaps = spark.createDataFrame([("B", day("2024-01-08"))], "security_id string, missing_session date")
    history = bars([bar("B", "2024-01-08", 7.0), bar("B", "2024-01-08", 7.0)])
    assert rows_of(C.gap_evidence(gaps, history), "in_history", "close", "history_rows") == [(True, 7.0, 2)]


def test_coverage_counts_only_what_the_lifecycle_allows(bars, spark):
    on = day("2024-01-05")
    held = bars([bar(s, d) for s in ("A", "B", "C", "D") for d in days("2024-01-01", 8) if (s, d) != ("B", on)] + [bar("A", None)])
    members = spark.createDataFrame([(s, f"T{s}") for s in ("A", "B", "C", "D", "E", "A")], "security_id string, ticker string")
    over = "VERIFIED_TERMINATED_PUBLIC_LISTING"
    registry = spark.createDataFrame(
        [("C", over, day("2024-01-02"), None), ("D", over, day("2024-02-01"), None), ("C", None, None, None)],
        "security_id string, lifecycle_status string, effective_date date, successor_ticker string",
    )
    row = C.allowed_coverage(members, registry, held, on).first().asDict()
    assert row == {"eligible": 5, "operational": 4, "allowed": 3, "present": 2, "absent": 1}
    none = C.allowed_coverage(members, registry.limit(0), held.limit(0), on).first().asDict()
    assert none == {"eligible": 5, "operational": 0, "allowed": 0, "present": 0, "absent": 0}
