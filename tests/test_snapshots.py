import pytest
from conftest import bar, day, rows_of

from barflow.operators import snapshots as S
from barflow.session import clustered

BASE = [("A", "2024-01-02", 10.0), ("A", "2024-01-03", 11.0), ("B", "2024-01-02", 20.0), ("B", "2024-01-03", 21.0)]


def frame(bars, rows):
    return bars([bar(s, d, c) for s, d, c in rows])


def replaced(**changes):
    return [tuple(changes.get(f"{s}{d[-1]}", (s, d, c))) for s, d, c in BASE]


@pytest.mark.parametrize(
    "candidate, reason, detail",
    [
        (replaced(A2=("A", "2024-01-04", 12.0)), "pure_late_arrival_window_advance", None),
        (BASE, "not_balanced_window_shift", None),
        (replaced(A3=("A", "2024-01-03", 99.0)), "overlap_values_changed", "open"),
        ([("C" if s == "B" else s, d, c) for s, d, c in BASE], "security_set_changed", None),
        ([*BASE, ("A", "2024-01-04", 12.0)], "per_security_row_counts_changed", None),
        (replaced(A2=("A", "2024-01-05", 12.0)), "added_after_as_of", None),
        (replaced(A3=("A", "2024-01-01", 9.0)), "not_forward_window_advance", "A"),
        (replaced(A3=("A", "2024-01-02", 10.0)), "duplicate_keys", None),
    ],
)
def test_window_advance_reasons(bars, candidate, reason, detail):
    row = S.window_advance_diff(frame(bars, BASE), frame(bars, candidate), day("2024-01-04")).first()
    assert (row["safe"], row["reason"], row["detail"]) == (reason.startswith("pure"), reason, detail)


def test_window_advance_missing_columns_and_details(bars):
    base = frame(bars, BASE)
    assert S.window_advance_diff(base, base.drop("volume"), day("2024-01-04")).first()["reason"] == "missing_required_columns"
    moved = frame(bars, replaced(A2=("A", "2024-01-04", 12.0)))
    assert rows_of(S.window_advance_details(base, moved)) == [("A", "2024-01-02", "2024-01-04")]


def test_null_and_nan_count_as_equal(bars):
    rows = [bar("A", "2024-01-02", close=None), bar("A", "2024-01-03", adj_close=float("nan"))]
    new = [bar("A", "2024-01-03", adj_close=float("nan")), bar("A", "2024-01-04")]
    assert S.window_advance_diff(bars(rows), bars(new), day("2024-01-04")).first()["safe"]


@pytest.mark.parametrize(
    "candidate, reason",
    [
        (BASE[:2], "pure_security_set_reduction"),
        (BASE, "not_security_set_reduction"),
        ([*BASE[:2], ("C", "2024-01-02", 1.0)], "not_security_set_reduction"),
        (BASE[:1], "retained_row_count_changed"),
        ([BASE[0], ("A", "2024-01-03", 5.0)], "retained_values_changed"),
        ([BASE[0], ("A", "2024-01-09", 11.0)], "retained_values_changed"),
        ([BASE[0], BASE[0]], "duplicate_keys"),
    ],
)
def test_set_reduction_reasons(bars, candidate, reason):
    row = S.set_reduction_diff(frame(bars, BASE), frame(bars, candidate)).first()
    assert (row["safe"], row["reason"]) == (reason.startswith("pure"), reason)
    assert row["removed_securities"] == (0 if candidate is BASE else 1)


def test_removed_and_not_eligible(bars):
    base = frame(bars, BASE)
    assert rows_of(S.removed_securities(base, base.filter("security_id = 'A'"))) == [("B",)]
    assert rows_of(S.not_eligible(base, base.filter("security_id = 'A'"))) == [("B",)]


FLAG_SCHEMA = (
    "security_id string, history_status string, history_rows long, history_last_date date, peer_date date, rolling_last_date date,"
    " ready_last_date date, in_ready boolean, declared_ready boolean, history_date_problems long, rolling_dates_absent_from_history long"
)
D1, D2 = day("2024-01-01"), day("2024-01-02")


@pytest.mark.parametrize(
    "changes, flags",
    [
        ({}, []),
        ({"history_rows": 100}, ["insufficient_history"]),
        ({"peer_date": D2, "history_rows": 9}, ["insufficient_history", "behind_exchange_peers_calendar_unverified"]),
        ({"history_status": "missing_history"}, ["missing_history"]),
        ({"history_status": "history_read_error"}, ["history_read_error"]),
        ({"rolling_last_date": None}, ["history_rolling_date_mismatch", "rolling_ready_date_mismatch"]),
        ({"ready_last_date": D2}, ["rolling_ready_date_mismatch"]),
        ({"declared_ready": False}, ["readiness_export_membership_mismatch"]),
        ({"history_date_problems": 2}, ["invalid_or_duplicate_history_dates"]),
        ({"rolling_dates_absent_from_history": 1}, ["rolling_dates_absent_from_history"]),
    ],
)
def test_freshness_flags(spark, changes, flags):
    row = dict(
        security_id="A", history_status="available", history_rows=300, history_last_date=D1, peer_date=D1, rolling_last_date=D1,
        ready_last_date=D1, in_ready=True, declared_ready=True, history_date_problems=0, rolling_dates_absent_from_history=0,
    )
    row.update(changes)
    out = S.freshness_flags(spark.createDataFrame([tuple(row.values())], FLAG_SCHEMA), 250)
    assert out.first()["flags"] == flags
    assert S.flag_counts(out).count() == len(flags)


def test_stage_reconcile_counts_date_problems(bars, spark):
    members = spark.createDataFrame([("A", "TA", "X"), ("B", "TB", "X"), ("C", "TC", None)], "security_id string, ticker string, exchange string")
    history = bars([bar("A", "2024-01-01"), bar("A", "2024-01-02"), bar("A", "2024-01-02"), bar("C", "2024-01-01") | {"date": None}])
    rolling = bars([bar("A", "2024-01-02"), bar("A", "2024-01-03"), bar("B", "2024-01-01")])
    ready = rolling.filter("security_id = 'A'")
    reference = bars([bar("A", "2024-01-01")])
    out = {r["security_id"]: r for r in S.peer_lag(S.stage_reconcile(members, history, rolling, ready, reference, ready)).collect()}
    a = out["A"]
    assert (a["history_rows"], a["history_date_problems"], a["rolling_dates_absent_from_history"]) == (3, 1, 1)
    assert (a["in_ready"], a["declared_ready"], a["advanced_since_reference"]) == (True, True, True)
    assert out["B"]["history_status"] == "missing_history" and out["B"]["peer_date"] == D2
    assert out["C"]["history_status"] == "history_read_error" and out["C"]["peer_date"] is None


def test_membership_diff(spark):
    make = lambda rows: spark.createDataFrame(rows, "security_id string, ticker string")
    old, new = make([("A", "a"), ("B", "b"), ("C", "c")]), make([("A", "a"), ("B", "bb"), ("D", "d")])
    assert rows_of(S.membership_diff(old, new)) == [
        ("B", "ticker_change", "b", "bb"), ("C", "removed", "c", None), ("D", "added", None, "d"),
    ]
    assert S.membership_diff(None, new).count() == 0


def test_missing_columns_and_missing_values(bars):
    base = frame(bars, BASE)
    assert S.set_reduction_diff(base, base.drop("volume")).first()["reason"] == "missing_required_columns"
    assert S.window_advance_diff(base.drop("ticker"), base, day("2024-01-04")).first()["reason"] == "missing_required_columns"
    null = bars([bar(s, d, c, adj_close=None) for s, d, c in BASE])
    nan = bars([bar(s, d, c, adj_close=float("nan")) for s, d, c in BASE[:2]])
    row = S.set_reduction_diff(null, nan).first()
    assert (row["safe"], row["removed_securities"]) == (True, 1)
    named = bars([bar(s, d, c, ticker="other") for s, d, c in BASE[:2]])
    row = S.set_reduction_diff(base, named).first()
    assert (row["reason"], row["detail"]) == ("retained_values_changed", "ticker")


def test_diffs_hash_and_do_not_sort(bars):
    base = frame(bars, BASE)
    plan = S.window_advance_diff(base, base, day("2024-01-04"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate(key=[security_id" not in plan


def test_clustered_snapshots_are_compared_in_place(bars):
    """Sides clustered by security meet without a shuffle; keys with a NULL are grouped as before."""
    base = frame(bars, BASE)
    one, other = clustered(base, "one"), clustered(base.limit(3), "other")
    plan = S.window_advance_diff(one, other, day("2024-01-04"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(security_id, date" not in plan
    odd = bars([bar("A", "2024-01-01"), bar("A", None), bar("A", None), bar(None, "2024-01-01")])
    rows = S._key_rows(odd, odd.filter("security_id is not null"))
    assert rows_of(rows, "security_id", "date", "old_n", "new_n") == sorted(
        [("A", day("2024-01-01"), 1, 1), ("A", None, 2, 2), (None, day("2024-01-01"), 1, 0)], key=repr
    )
