import pytest
from conftest import bar, day, days, rows_of

from barflow.operators import merge as M
from barflow.schemas import BAR_COLUMNS, ContractError


def keys(spark, pairs):
    return spark.createDataFrame([(s, day(d)) for s, d in pairs], "security_id string, date date")


def test_append_adds_later_and_missing_dates_but_never_overwrites(bars):
    history = bars([bar("A", "2024-01-02", 10.0), bar("A", "2024-01-04", 11.0)])
    fresh = bars([bar("A", "2024-01-02", 99.0), bar("A", "2024-01-03", 12.0), bar("A", "2024-01-05", 13.0), bar("N", "2024-01-05", 5.0)])
    rows = M.merge_append_rows(history, fresh)
    assert rows_of(rows, "security_id", "date", "merge_class") == [
        ("A", day("2024-01-03"), "backfill"), ("A", day("2024-01-05"), "addition"), ("N", day("2024-01-05"), "addition"),
    ]
    merged = M.merge_append(history, fresh)
    assert dict(rows_of(merged.filter("security_id = 'A'"), "date", "close"))[day("2024-01-02")] == 10.0
    again = M.merge_append(merged, fresh)
    assert rows_of(again) == rows_of(merged)
    assert rows_of(M.merge_append(history, history.limit(0))) == rows_of(history)


def test_exact_merge_adds_only_fully_matched_securities(bars, spark):
    history = bars([bar("A", "2024-01-02"), bar("B", "2024-01-02"), bar("C", "2024-01-03"), bar("D", "2024-01-02"), bar("D", "2024-01-02")])
    adds = bars([bar("A", "2024-01-03"), bar("B", "2024-01-04"), bar("C", "2024-01-03"), bar("D", "2024-01-03"), bar("E", "2024-01-03"), bar("E", "2024-01-03")])
    targets = keys(spark, [(s, "2024-01-03") for s in "ABCDE"])
    assert dict(rows_of(M.merge_exact_violations(history, adds, targets))) == {
        "B": "repair_rows_do_not_match_targets",
        "C": "target_already_in_history",
        "D": "history_null_or_duplicate_dates",
        "E": "repair_null_or_duplicate_dates",
    }
    merged = M.merge_exact(history, adds, targets)
    assert merged.count() == history.count() + 1
    assert tuple(M.preservation_check(history, merged).first()) == (0, 1)


def test_preservation_check_sees_changes_and_duplicates(bars):
    before = bars([bar("A", "2024-01-02"), bar("A", "2024-01-03", adj_close=float("nan")), bar("A", "2024-01-04", close=None)])
    assert tuple(M.preservation_check(before, before).first()) == (0, 0)
    changed = bars([bar("A", "2024-01-02", 10.5), bar("A", "2024-01-03", adj_close=float("nan")), bar("A", "2024-01-04", close=None)])
    assert tuple(M.preservation_check(before, changed).first()) == (1, 1)
    assert tuple(M.preservation_check(before, before.union(before)).first()) == (0, 3)


def test_replace_bad_needs_matching_evidence_and_a_sound_replacement(bars):
    d = "2024-01-02"
    stored = bars([
        bar("A", d, high=9.0), bar("B", d, high=9.0), bar("C", d, high=9.0), bar("D", d), bar("E", d, high=9.0), bar("E", d, high=9.0),
        bar("A", "2024-01-03", high=9.0),
    ])
    evidence = bars([bar("A", d, high=9.0), bar("B", d, high=8.0), bar("C", d, high=9.0), bar("D", d, high=9.0), bar("E", d, high=9.0), bar("F", d, high=9.0)])
    fix = bars([bar(s, d, high=12.0) for s in "ABDEF"] + [bar("C", d, high=7.0)])
    plan = M.merge_replace_bad_plan(stored, evidence, fix)
    assert dict(rows_of(plan, "security_id", "action")) == {
        "A": "replaced", "B": "differs_from_evidence", "C": "invalid_replacement", "D": "unchanged",
        "E": "not_exactly_one_row", "F": "not_exactly_one_row",
    }
    merged = M.merge_replace_bad(stored, evidence, fix)
    assert merged.count() == stored.count()
    assert tuple(M.preservation_check(stored, merged).first()) == (1, 1)
    assert rows_of(M.merge_replace_bad(merged, evidence, fix)) == rows_of(merged)


def test_upsert_date_replaces_or_only_adds(bars):
    d = "2024-01-03"
    stored = bars([bar("A", "2024-01-02"), bar("A", d), bar("B", d, 20.0), bar("C", d)])
    fresh = bars([bar("A", d, 11.0), bar("C", d), bar("N", d, 5.0), bar("A", "2024-01-02", 99.0)])
    out = M.merge_upsert_date(stored, fresh, day(d))
    assert rows_of(out, "security_id", "date", "close") == [
        ("A", day("2024-01-02"), 10.0), ("A", day(d), 11.0), ("B", day(d), 20.0), ("C", day(d), 10.0), ("N", day(d), 5.0),
    ]
    report = M.merge_upsert_date_report(stored, fresh, day(d))
    assert dict(rows_of(report, "security_id", "change")) == {"A": "changed", "C": "same", "N": "added"}
    absent = M.merge_upsert_date(stored, fresh, day(d), only_if_absent=True)
    assert absent.count() == 5 and absent.filter("close = 11.0").count() == 0


def bench(bars, sid, closes, factors):
    return [bar(sid, d, c, adj_close=c * f) for d, c, f in closes_factors(closes, factors)]


def closes_factors(closes, factors):
    return [(d, c, f) for d, c, f in zip(days("2024-01-01", len(closes)), closes, factors) if c is not None]


def test_benchmark_verdicts_and_rebase(bars):
    c = [100.0, 101.0, 102.0, 103.0]
    old = bars(
        bench(bars, "U", [*c[:3]], [1.0] * 3) + bench(bars, "P", c[:3], [1.0] * 3) + bench(bars, "R", c[:3], [1.0] * 3)
        + bench(bars, "O", c[:3], [1.0] * 3) + bench(bars, "S", c[:2], [1.0] * 2) + bench(bars, "N", c[:1], [1.0])
    )
    new = bars(
        bench(bars, "U", [None, *c[1:]], [0.5] * 4)  # one factor over two rows: rebase
        + bench(bars, "P", [None, *c[1:]], [1, 0.5, 1.0, 1.0])  # one row only: not uniform
        + bench(bars, "R", [None, 101.5, 102.0, 103.0], [1.0] * 4)  # a revised close
        + bench(bars, "O", [None, *c[1:]], [1.0] * 4)
        + bench(bars, "S", [None, *c[1:]], [0.5] * 4)  # a single overlap row may not shift
        + bench(bars, "N", [None, None, *c[2:]], [1.0] * 4)
    )
    verdicts = {r["security_id"]: (r["overlap_rows"], r["verdict"], r["rebase_factor"]) for r in M.benchmark_verdicts(old, new).collect()}
    assert verdicts == {
        "U": (2, "rebase", 0.5), "P": (2, "adjustment_basis_changed", 1.0), "R": (2, "historical_closes_revised", 1.0),
        "O": (2, "append", 1.0), "S": (1, "adjustment_basis_changed", 1.0), "N": (0, "no_overlap", 1.0),
    }
    twice = M.benchmark_verdicts(old, new.unionByName(new.filter("security_id = 'O'")))
    assert twice.filter("security_id = 'O'").first()["verdict"] == "invalid_bars"
    unsound = M.benchmark_verdicts(old.replace(101.0, -1.0, ["low", "close"]), new)
    assert {r["verdict"] for r in unsound.collect()} >= {"invalid_bars"}
    merged = M.benchmark_merge(old, new)
    assert rows_of(merged.filter("security_id = 'U'"), "adj_close") == [(50.0,), (50.5,), (51.0,), (51.5,)]
    assert {r[0] for r in merged.select("security_id").distinct().collect()} == {"U", "O"}


def test_set_algebra_and_violation_gate(bars):
    left, right = bars([bar("A", "2024-01-02"), bar("B", "2024-01-02")]), bars([bar("B", "2024-01-02"), bar("C", "2024-01-02")])
    assert rows_of(M.set_algebra(left, right)) == [("A", "left_only"), ("B", "both"), ("C", "right_only")]
    with pytest.raises(ContractError):
        M.raise_on_rows(left.select(*BAR_COLUMNS), "must be empty")
    M.raise_on_rows(left.limit(0), "must be empty")


def test_append_takes_a_repeated_download_once_and_needs_a_date(bars):
    history = bars([bar("A", "2024-01-01")])
    fresh = bars([bar("A", "2024-01-02", 11.0), bar("A", "2024-01-02", 10.0), bar("A", None)])
    assert rows_of(M.merge_append(history, fresh), "date", "close") == [(day("2024-01-01"), 10.0), (day("2024-01-02"), 10.0)]
    ordered = fresh.withColumn("n", -fresh["close"])
    assert rows_of(M.merge_append_rows(history, ordered, "n"), "close", "merge_class") == [(11.0, "addition")]


def test_benchmark_merge_refuses_an_unsound_result(bars):
    old = bars([bar("O", d, 100.0, adj_close=1e-300) for d in days("2024-01-01", 3)])
    new = bars([bar("O", d, 100.0, adj_close=1e-305) for d in days("2024-01-02", 3)])
    merged = M.benchmark_merge(old.filter("date < '2024-01-02'").unionByName(old.filter("date >= '2024-01-02'")), new)
    assert {r["adj_close"] > 0 for r in merged.collect()} == {True}
    far = bars([bar("O", d, 100.0, adj_close=1e-310) for d in days("2024-01-01", 1)] + [bar("O", d, 100.0, adj_close=1e-5) for d in days("2024-01-02", 2)])
    tiny = bars([bar("O", d, 100.0, adj_close=1e-30) for d in days("2024-01-02", 3)])
    with pytest.raises(ContractError, match="unsound after the merge"):
        M.benchmark_merge(far, tiny)


def test_repeated_evidence_and_replacements_add_no_row(bars):
    stored = bars([bar("A", "2024-01-02", high=1.0), bar("B", "2024-01-02", high=1.0), bar("C", "2024-01-02", high=1.0)])
    new = bars([bar(s, "2024-01-02") for s in "ABC"])
    evidence = stored.unionByName(stored.filter("security_id = 'A'")).unionByName(bars([bar("C", "2024-01-02", high=2.0)]))
    replacements = new.unionByName(new).unionByName(bars([bar("B", "2024-01-02", 12.0)]))
    plan = dict(rows_of(M.merge_replace_bad_plan(stored, evidence, replacements), "security_id", "action"))
    assert plan == {"A": "replaced", "B": "conflicting_replacement", "C": "conflicting_evidence"}
    merged = M.merge_replace_bad(stored, evidence, replacements)
    assert rows_of(merged, "security_id", "high") == [("A", 11.0), ("B", 1.0), ("C", 1.0)]


def test_upsert_date_takes_exactly_one_fresh_row(bars):
    stored = bars([bar("A", "2024-01-02"), bar("B", "2024-01-02"), bar("B", "2024-01-03")])
    fresh = bars([bar("A", "2024-01-02", 12.0), bar("A", "2024-01-02", 12.0), bar("B", "2024-01-02", 12.0), bar("N", "2024-01-02"), bar("N", "2024-01-02")])
    when = day("2024-01-02")
    assert dict(rows_of(M.merge_upsert_date_report(stored, fresh, when), "security_id", "change")) == {
        "A": "not_exactly_one_row", "B": "changed", "N": "not_exactly_one_row",
    }
    assert rows_of(M.merge_upsert_date(stored, fresh, when), "security_id", "date", "close") == [
        ("A", when, 10.0), ("B", when, 12.0), ("B", day("2024-01-03"), 10.0),
    ]
    assert rows_of(M.merge_upsert_date(stored, fresh, when, only_if_absent=True)) == rows_of(stored)


def test_benchmark_merge_returns_written_bars(bars):
    """The check of the result and its reader share one computation."""
    old, new = bars([bar("B", f"2024-01-0{n}") for n in (1, 2, 3)]), bars([bar("B", f"2024-01-0{n}") for n in (2, 3, 4)])
    merged = M.benchmark_merge(old, new)
    assert "Join" not in merged._jdf.queryExecution().executedPlan().toString()
    assert [str(d) for (d,) in rows_of(merged, "date")] == [f"2024-01-0{n}" for n in (1, 2, 3, 4)]
