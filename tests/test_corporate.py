import random
from datetime import date, timedelta

from conftest import bar, day, days, rows_of
from pyspark.sql import functions as F

from barflow.operators import corporate as K

EVENTS = "security_id string, effective_date date, split_factor double, provider_ticker string"


def test_extract_classifies_every_source_row(spark):
    values = [None, "x", "0", "-2", "NaN", "Infinity", "1", "1.0", "10", "0.1"]
    rows = [(f"S{i}", day("2024-01-02"), v, "T") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "security_id string, date date, split_factor string, provider_ticker string")
    got = [r["event_class"] for r in K.split_extract(df).orderBy("security_id").collect()]
    bad = "invalid_split_factor"
    assert got == ["null_split_factor", "non_numeric_split_factor", bad, bad, bad, bad, "none", "none", "event", "event"]
    assert rows_of(K.split_events(df), "split_factor") == [(0.1,), (10.0,)]


def test_event_issues(spark):
    d = day("2024-01-02")
    rows = [("A", d, 2.0, "a"), ("A", d, 1.0, "a"), (" ", d, 2.0, "a"), ("A", d, 2.0, None), ("A", d, float("nan"), "a"), ("A", d, -1.0, "a")]
    got = [r[0] for r in rows_of(K.split_event_issues(spark.createDataFrame(rows, EVENTS)), "issue")]
    assert got == ["identity_required"] * 2 + ["invalid_split_factor"] * 3


def test_dedupe_marks_conflicts(spark):
    d = day("2024-06-10")
    df = spark.createDataFrame([("A", d, 10.0, "a"), ("A", d, 10.0 + 1e-13, "a"), ("B", d, 10.0, "b"), ("B", d, 5.0, "b")], EVENTS)
    assert rows_of(K.split_dedupe(df), "security_id", "statements", "conflict") == [("A", 2, False), ("B", 2, True)]


def test_factor_boundaries_and_order(bars, spark):
    events = spark.createDataFrame(
        [("A", day("2024-06-10"), 10.0, "a"), ("A", day("2024-07-01"), 0.1, "a"), ("B", day("2024-06-10"), 3.0, "b")], EVENTS
    )
    stock = bars([bar("A", d, 1000.0, volume=100) for d in ("2024-06-07", "2024-06-10", "2024-07-01")] + [bar("C", "2024-06-07")])
    at = lambda when: dict(rows_of(K.split_factor(stock, events, day(when)).filter("security_id = 'A'"), "date", "factor"))
    assert at("2024-06-09") == {day("2024-06-07"): 1.0, day("2024-06-10"): 1.0, day("2024-07-01"): 1.0}
    assert at("2024-06-10") == {day("2024-06-07"): 10.0, day("2024-06-10"): 1.0, day("2024-07-01"): 1.0}
    assert at("2024-07-01")[day("2024-06-07")] == 10.0 * 0.1
    row = K.split_factor(stock, events, day("2024-06-10")).filter("date = '2024-06-07' and security_id = 'A'").first()
    assert (row["normalized_close"], row["normalized_volume"]) == (100.0, 1000.0)
    assert K.split_factor(stock, events, day("2025-01-01")).filter("security_id = 'C'").first()["factor"] == 1.0


def test_split_stats_and_crosscheck(spark):
    d1, d2 = day("2024-01-02"), day("2024-01-03")
    events = spark.createDataFrame([("A", d1, 2.0, "a"), ("A", d1, 2.0, "a"), ("A", d2, 0.5, "a"), ("B", d1, 3.0, "b")], EVENTS)
    tickers = lambda t: spark.createDataFrame([(x,) for x in t], "ticker string")
    row = K.split_stats(events, tickers("abc"), tickers("ab")).first()
    assert (row["event_rows"], row["securities"], row["forward_events"], row["reverse_events"]) == (3, 2, 2, 1)
    assert (row["gap_count"], row["gap_rate"]) == (1, 0.333333)
    facts = lambda rows: spark.createDataFrame([(s, d, f, s) for s, d, f in rows], EVENTS)
    out = K.split_crosscheck(
        facts([("A", d1, 2.0), ("B", d1, 3.0), ("C", d1, 4.0)]),
        facts([("A", d1, 2.0 + 1e-13), ("B", d1, 3.0), ("D", d1, 9.0)]),
        facts([("A", d1, 2.0), ("B", d1, 3.1), ("C", d1, 4.0)]),
    )
    assert rows_of(out, "security_id", "cross_provider_match", "status") == [
        ("A", True, "PASS"), ("B", False, "FAIL"), ("C", False, "FAIL"), ("D", False, "unexpected"),
    ]


ALIASES = "security_id string, provider string, provider_ticker string, valid_from date, valid_to date, evidence string"


def test_resolution_is_date_bounded_and_fails_closed(spark):
    aliases = spark.createDataFrame(
        [
            ("S1", "eod", "OLD", None, day("2026-07-12"), "e"),
            ("S1", "eod", "NEW", day("2026-07-13"), None, "e"),
            ("S2", "eod", "DUP", None, None, "e"),
            ("S3", "eod", "DUP", day("2026-01-01"), None, "e"),
        ],
        ALIASES,
    )
    events = [
        (" EOD", "old ", "2026-07-12", "S1"), ("eod", "OLD", "2026-07-13", None), ("eod", "NEW", "2026-07-13", "S1"),
        ("eod", "NEW", "2026-07-12", None), ("eod", "DUP", "2025-12-31", "S2"), ("eod", "DUP", "2026-01-01", None),
        ("other", "OLD", "2026-01-01", None), ("eod", "NONE", "2026-01-01", None),
    ]
    df = spark.createDataFrame([(i, p, t, day(d)) for i, (p, t, d, _) in enumerate(events)], "i int, provider string, provider_ticker string, event_date date")
    out = {r["i"]: r for r in K.resolve_alias(df, aliases).collect()}
    assert [out[i]["security_id"] for i in range(len(events))] == [e[3] for e in events]
    assert all((out[i]["resolution"] == "RESOLVED") == (e[3] is not None) for i, e in enumerate(events))


def test_resolution_equals_all_pairs(spark):
    """Random spans, open and reversed ones among them, and one ticker with thousands of spans and most events."""
    rng = random.Random(12)
    first = date(1999, 12, 1)
    rows, events = [], []
    for i in range(3000):
        a = first + timedelta(days=rng.randrange(900))
        b = a + timedelta(days=rng.choice([-2, 0, 1, 2, 5, 63, 64, 400]))
        ticker = "HOT" if i < 2600 else f"T{rng.randrange(25)}"
        rows.append((f"S{rng.randrange(3) if ticker == 'HOT' else rng.randrange(9)}", "eod", ticker, None if i % 97 == 96 and ticker != "HOT" else a, None if i % 89 == 88 and ticker != "HOT" else b, "e"))
    # days on which HOT is one security's alone
    rows = [r for r in rows if r[2] != "HOT" or r[0] == "S0" or r[3].year > 2000]
    for i in range(1500):
        events.append((i, "eod", "HOT" if i % 3 else f"T{rng.randrange(27)}", first + timedelta(days=rng.randrange(-30, 1300))))
    events += [(9000, "eod", "T1", None), (9001, None, "T1", first), (9002, "eod", "T1", date(1, 1, 1)), (9003, "eod", "T2", date(9999, 12, 31))]
    want = {}
    for i, p, t, d in events:
        ids = {r[0] for r in rows if d and p and r[2] == t and (r[3] or date.min) <= d <= (r[4] or date.max)}
        want[i] = ids.pop() if len(ids) == 1 else None
    df = spark.createDataFrame(events, "i int, provider string, provider_ticker string, event_date date")
    got = {r["i"]: r["security_id"] for r in K.resolve_alias(df, spark.createDataFrame(rows, ALIASES)).collect()}
    assert got == want
    assert 100 < sum(v is not None for v in want.values()) < len(want) - 100


def test_alias_overlaps_against_all_pairs(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(150):
        a = date(2020, 1, 1) + timedelta(days=rng.randrange(300))
        b = a + timedelta(days=rng.randrange(40))
        rows.append((f"S{rng.randrange(4)}", "eod", f"T{rng.randrange(25)}", None if rng.random() < 0.03 else a, None if rng.random() < 0.03 else b, "e"))
    lo, hi = date.min, date.max
    want = {}
    for i, x in enumerate(rows):
        for y in rows[i + 1 :]:
            if x[2] == y[2] and x[0] != y[0]:
                start, end = max(x[3] or lo, y[3] or lo), min(x[4] or hi, y[4] or hi)
                if start <= end:
                    want[x[2]] = min(want.get(x[2], hi), start)
    got = {r["provider_ticker"]: r["first_overlap"] for r in K.alias_overlaps(spark.createDataFrame(rows, ALIASES)).collect()}
    assert len(want) > 5 and got == want


def test_alias_issues(spark):
    rows = [("S", "p", "t", day("2024-02-01"), day("2024-01-01"), "e"), ("", "p", "t", None, None, "e"), ("S", "p", "t", None, None, None), ("S", "p", "t", None, None, "e")]
    assert [r[0] for r in rows_of(K.alias_issues(spark.createDataFrame(rows, ALIASES)), "issue")] == [
        "invalid_date_range", "lineage_field_missing", "lineage_field_missing",
    ]


def test_lifecycle_gate_boundaries(spark):
    members = spark.createDataFrame([(s, f"T{s}") for s in "ABCDE"], "security_id string, ticker string")
    d = day("2026-09-02")
    registry = spark.createDataFrame(
        [
            ("A", K.BLOCKING_STATUSES[0], d, None),
            ("B", K.BLOCKING_STATUSES[1], None, None),
            ("C", K.TICKER_CHANGE_STATUS, d, " NEW "),
            ("D", K.TICKER_CHANGE_STATUS, d, " "),
        ],
        "security_id string, lifecycle_status string, effective_date date, successor_ticker string",
    )
    at = lambda when: {r["security_id"]: (r["allowed"], r["acquisition_ticker"]) for r in K.lifecycle_gate(members, registry, when).collect()}
    before, on = at(day("2026-09-01")), at(d)
    assert (before["A"], on["A"]) == ((True, "TA"), (False, "TA"))
    assert on["B"] == (True, "TB")
    assert (before["C"], on["C"]) == ((True, "TC"), (True, "NEW"))
    assert on["D"] == (True, "TD") and on["E"] == (True, "TE")


def test_provider_symbol_needs_both_keys(spark):
    members = spark.createDataFrame([("US74624M1027", " pstg "), ("OTHER", "PSTG"), ("X", "brk.b")], "security_id string, ticker string")
    registry = spark.createDataFrame([("US74624M1027", "PSTG", "P")], "security_id string, ticker string, symbol string")
    out = K.provider_symbol(members, registry)
    assert rows_of(out, "security_id", "symbol") == [("OTHER", "PSTG"), ("US74624M1027", "P"), ("X", "BRK-B")]


def test_factors_of_a_security_with_many_events(bars, spark):
    d = days("2000-01-01", 400)
    events = spark.createDataFrame([("A", x, 1.01, "a") for x in d], EVENTS)
    row = K.split_factor(bars([bar("A", "1999-12-31")]), events, day("2010-01-01")).select(F.col("factor")).first()
    want = 1.0
    for _ in d:
        want *= 1.01
    assert row[0] == want


def test_splits_from_an_adjustment_column(spark):
    rows = spark.createDataFrame(
        [("A", day("2024-01-01"), "0.0"), ("A", day("2024-01-02"), "2.0"), ("A", day("2024-01-03"), None), ("A", day("2024-01-04"), "-1"), ("A", day("2024-01-05"), "x")],
        "security_id string, date date, splits string",
    )
    out = K.split_extract(rows, "splits", adjustments=True)
    assert [r[0] for r in out.orderBy("date").select("event_class").collect()] == ["none", "event", "none", "invalid_split_factor", "non_numeric_split_factor"]
    assert {r[0] for r in K.split_extract(rows, "absent", adjustments=True).select("event_class").collect()} == {"missing_split_column"}


def test_repeated_registry_rows_give_one_row_a_member(spark):
    members = spark.createDataFrame([("A", "TA"), ("B", "TB"), ("C", "x.y")], "security_id string, ticker string")
    kind = "security_id string, lifecycle_status string, effective_date date, successor_ticker string"
    block, change = K.BLOCKING_STATUSES[0], K.TICKER_CHANGE_STATUS
    registry = spark.createDataFrame(
        [("A", block, day("2024-01-02"), None), ("A", block, day("2024-01-02"), None), ("A", change, day("2024-01-03"), "NEW"),
         ("B", change, day("2024-01-01"), "OLD"), ("B", change, day("2024-01-03"), "NEW"), ("B", change, day("2025-01-01"), "LATER")],
        kind,
    )
    gate = K.lifecycle_gate(members, registry, day("2024-06-01"))
    assert rows_of(gate, "security_id", "allowed", "acquisition_ticker") == [("A", False, "NEW"), ("B", True, "NEW"), ("C", True, "x.y")]
    assert rows_of(K.repeated_keys(registry, ["security_id"])) == [("A", 3), ("B", 3)]
    symbols = spark.createDataFrame(
        [("A", "ta", "SA"), ("A", " TA ", "SA"), ("B", "TB", "S1"), ("B", "tb", "S2")], "security_id string, ticker string, symbol string"
    )
    assert rows_of(K.provider_symbol(members, symbols), "security_id", "symbol") == [("A", "SA"), ("B", None), ("C", "X-Y")]
    assert rows_of(K.provider_symbol_conflicts(symbols), "security_id", "ticker") == [("A", "TA"), ("B", "TB")]
