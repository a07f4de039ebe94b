from datetime import date

from conftest import bar, day, days, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators import normalize as N
from barflow.schemas import BARS, ContractError
import pytest

RAW = "date string, security_id string, ticker string, open string, high string, low string, close string, adj_close string, volume string, src_ord long"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def text_row(sid, when, ord_, close="10", high="11", low="9", adj="10", volume="5"):
    return (when, sid, f"T{sid}", close, high, low, close, adj, volume, ord_)


def test_normalize_history_drops_dedupes_and_accepts(spark):
    rows = [
        text_row("A", "2024-01-03", 3, close="10.5"),
        text_row("A", "2024-01-02", 1),
        text_row("A", "2024-01-02", 2, close="10.25", volume=None),  # later source row wins, no volume
        text_row("A", "2024-01-04", 4, high="n/a"),  # does not parse: dropped
        text_row("A", "bad-date", 5),
    ]
    out = N.normalize_history(raw(spark, rows))
    assert rows_of(out, "date", "close", "volume", "verdict") == [
        (date(2024, 1, 2), 10.25, 0, "accepted"),
        (date(2024, 1, 3), 10.5, 5, "accepted"),
    ]


@pytest.mark.parametrize(
    "broken, verdict",
    [
        (dict(close="-10", low="-11"), "negative_price"),
        (dict(high="8"), "high_below_low"),
        (dict(adj="NaN"), "qc_rejected"),
        (dict(adj=None), "qc_rejected"),
        (dict(volume="-3"), "qc_rejected"),
        (dict(close="11.5"), "qc_rejected"),
    ],
)
def test_one_bad_bar_rejects_only_its_security(spark, broken, verdict):
    rows = [text_row("A", "2024-01-02", 1), text_row("A", "2024-01-03", 2, **broken), text_row("B", "2024-01-02", 1)]
    out = N.normalize_history(raw(spark, rows))
    assert dict(rows_of(out.select("security_id", "verdict").distinct())) == {"A": verdict, "B": "accepted"}
    assert rows_of(N.accepted(out), "security_id") == [("B",)]


def test_adj_close_falls_back_only_without_the_column(spark):
    rows = raw(spark, [text_row("A", "2024-01-02", 1, adj=None)])
    assert N.normalize_history(rows.drop("adj_close")).first()["adj_close"] == 10.0
    assert N.normalize_history(rows).first()["verdict"] == "qc_rejected"


def test_source_session_policies(spark):
    ts = spark.createDataFrame([("2024-01-03 02:30:00",)], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    row = ts.select(N.utc_session("ts"), N.exchange_session("ts")).first()
    assert (str(row[0]), str(row[1])) == ("2024-01-03", "2024-01-02")


def test_split_incomplete_conserves_rows_and_counts_duplicates(spark):
    rows = [
        text_row("A", "2024-01-02", 1),
        text_row("A", "2024-01-02", 2),
        text_row("A", "2024-01-03", 3, high=None),
        text_row("A", None, 4),
    ]
    got = N.split_incomplete_checks(N.split_incomplete(raw(spark, rows))).first()
    assert (got["valid_rows"], got["discarded_rows"], got["duplicate_valid_dates"]) == (2, 2, 1)


def test_select_session_classes(bars):
    t = "2024-01-03"
    rows = [
        bar("A", t),
        bar("B", t, close=None),
        bar("C", t),
        bar("C", t),
        bar("D", "2024-01-02"),
        bar("E", t, low=20.0),
    ]
    out = N.select_session(bars(rows), day(t))
    assert rows_of(out, "security_id", "session_class") == [
        ("A", "VALID"), ("B", "INVALID"), ("C", "NO_SINGLE_COMPLETE_ROW"), ("E", "INVALID"),
    ]
    population = bars([bar(s, t) for s in "ABCD"])
    assert rows_of(N.session_availability(population, out)) == [
        ("A", "valid"), ("B", "partial"), ("C", "partial"), ("D", "missing"),
    ]


def test_batch_then_single(spark):
    batch = raw(spark, [text_row("A", "2024-01-02", 1), text_row("B", "2024-01-02", 1, high="8"), text_row("C", "2024-01-02", 1, high="8")])
    single = raw(spark, [text_row("B", "2024-01-02", 1), text_row("A", "2024-01-03", 1), text_row("C", "2024-01-02", 1, low="12")])
    out = N.batch_then_single(batch, single)
    assert rows_of(out, "security_id", "source") == [("A", "batch"), ("B", "single")]
    assert rows_of(N.batch_then_single_failed(batch, single, out)) == [("C",)]


def test_adjusted_ohlc(bars):
    out = N.adjusted_ohlc(
        bars([
            bar("A", "2024-01-02", adj_close=5.0), bar("B", "2024-01-02", close=0.0), bar("C", "2024-01-02", adj_close=0.0),
            bar("D", "2024-01-02", high=9.9), bar("E", "2024-01-02", adj_close=float("inf")),
        ])
    )
    a = out.filter("security_id = 'A'").first()
    assert (a["open"], a["high"], a["low"], a["close"], a["volume"]) == (5.0, 5.5, 4.5, 5.0, 100)
    assert dict(rows_of(out, "security_id", "adjust_issue")) == {
        "A": None, "B": "invalid_adjustment_factor", "C": "invalid_adjustment_factor",
        "D": "adjusted_high_violates_range", "E": "invalid_adjustment_factor",
    }


def test_qc_gate_counts_and_raises(bars):
    df = bars([bar("A", "2024-01-02"), bar("A", "2024-01-03", volume=-1)])
    assert tuple(N.qc_gate(df).first()) == (2, 1)
    with pytest.raises(ContractError, match="rejected 1 bars"):
        N.raise_on_bad_bars(df)
    assert N.raise_on_bad_bars(df.filter("volume > 0")).count() == 1


@pytest.mark.parametrize("failed, allowed", [(1, True), (2, False)])
def test_failure_rate_gate_threshold(spark, failed, allowed):
    status = ["failed"] * failed + ["updated"] * (10 - failed) + ["skipped"] * 50
    row = N.failure_rate_gate(spark.createDataFrame([(s,) for s in status], "status string")).first()
    assert (row["attempted"], row["publish_allowed"]) == (10, allowed)


def test_failure_rate_gate_without_attempts(spark):
    row = N.failure_rate_gate(spark.createDataFrame([], "status string")).first()
    assert row["failure_rate"] is None and row["publish_allowed"] is False


def test_monotonic_check_across_segments(spark):
    ordered = [("A", d, i) for i, d in enumerate(days("2024-01-01", 50))]
    swapped = [("B", d, i) for i, d in enumerate(days("2024-01-01", 50))]
    swapped[9], swapped[10] = ("B", swapped[10][1], 9), ("B", swapped[9][1], 10)  # across a segment border
    repeated = [("C", day("2024-01-01"), 0), ("C", day("2024-01-01"), 1)]
    df = spark.createDataFrame(ordered + swapped + repeated, "security_id string, date date, src_ord long")
    out = N.monotonic_check(df, ["security_id"], segment_rows=10)
    assert rows_of(out, "security_id", "inversions", "strictly_increasing") == [("A", 0, True), ("B", 1, False), ("C", 1, False)]


def test_normalize_index_bars(spark):
    rows = []
    for i, d in enumerate(days("2024-01-01", 3)):
        rows.append(("GOOD", "^G", str(d), "10", "11", "9", "10", "5", i))
        rows.append(("BACK", "^B", str(d), "10", "11", "9", "10", "5", -i))
        rows.append(("ENV", "^E", str(d), "10", "9.5" if i == 1 else "11", "9", "10", "5", i))
        rows.append(("NEG", "^N", str(d), "10", "11", "9", "10", "-1" if i == 2 else "5", i))
    rows.append(("GOOD", "^G", "2024-02-01", "10", "11", "9", "10", None, 9))
    schema = "index_id string, source_symbol string, date string, open string, high string, low string, close string, volume string, src_ord long"
    out = N.normalize_index_bars(spark.createDataFrame(rows, schema), "P", "v1")
    got = {tuple(r) for r in out.select("index_id", "verdict").distinct().collect()}
    assert got == {("GOOD", "accepted"), ("BACK", "date_chronology"), ("ENV", "ohlc_envelope"), ("NEG", "negative_volume")}
    assert out.filter("index_id = 'GOOD'").count() == 3


def test_index_source_checks_look_at_recent_rows(spark):
    rows = [("I", d, 10.0, 11.0, 9.0, 10.0, float(100 + i)) for i, d in enumerate(days("2024-01-01", 80))]
    rows[5] = ("I", rows[5][1], 10.0, None, 9.0, 10.0, 1.0)  # old defect outside the window
    rows += [("J", d, 10.0, 11.0, 9.0, 10.0, 7.0) for d in days("2024-01-01", 80)]
    df = spark.createDataFrame(rows, "index_id string, date date, open double, high double, low double, close double, volume double")
    out = {r["index_id"]: r for r in N.index_source_checks(df).collect()}
    assert out["I"]["status"] == "PASS"
    assert out["J"]["status"] == "FAIL" and out["J"]["recent_volume_varies"] is False


def test_nth_bar(bars, spark):
    history = bars([bar("A", d, volume=-1 if i == 2 else 1) for i, d in enumerate(days("2024-01-01", 4))])
    targets = spark.createDataFrame(
        [("A", "TA", 2, "negative_volume"), ("A", "TA", 1, "negative_volume"), ("A", "XX", 2, "negative_volume"), ("A", "TA", 9, "nonfinite")],
        "security_id string, ticker string, position int, expected_rule string",
    )
    got = sorted(r["outcome"] for r in N.nth_bar(history, targets).collect())
    assert got == ["confirmed", "identity_differs", "outside_history", "rule_not_found"]


def test_finalized_filter_and_histogram(bars):
    df = bars([bar("A", d) for d in days("2024-01-01", 4)] + [bar("B", "2024-01-04")])
    assert N.finalized_filter(df, day("2024-01-02")).count() == 2
    assert rows_of(N.finalized_excluded(df, day("2024-01-02"))) == [(day("2024-01-03"), 1), (day("2024-01-04"), 2)]


def test_normalize_existing_keeps_last(spark):
    schema = T.StructType([*BARS.fields, T.StructField("src_ord", T.LongType())])
    cols = [f.name for f in schema.fields]
    rows = [{**bar("A", "2024-01-02"), "src_ord": 1}, {**bar("A", "2024-01-02", close=20.0), "src_ord": 2}, {**bar("A", "2024-01-03"), "date": None, "src_ord": 3}]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)
    assert rows_of(N.normalize_existing(df, "src_ord"), "close") == [(20.0,)]


def test_session_date_follows_the_zone(spark):
    rows = [text_row("A", "2024-01-01T23:00:00-05:00", 1), text_row("A", "2024-01-03", 2), text_row("A", "no date", 3)]
    assert rows_of(N.normalize_history(raw(spark, rows)), "date") == [(day("2024-01-02"),), (day("2024-01-03"),)]
    local = N.normalize_history(raw(spark, rows[:1]), session=N.exchange_session)
    assert rows_of(local, "date") == [(day("2024-01-01"),)]


def test_requested_index_without_rows_fails(bars, spark):
    rows = bars([bar("I", d, volume=v) for d, v in zip(days("2024-01-01", 3), (5, 7, 7))]).withColumnRenamed("security_id", "index_id")
    out = N.index_source_checks(rows, requested=spark.createDataFrame([("I",), ("J",)], "index_id string"))
    assert rows_of(out, "index_id", "nonempty", "status", "volume_recent_min", "volume_recent_max", "volume_recent_unique") == [
        ("I", True, "PASS", 5.0, 7.0, 2), ("J", False, "FAIL", None, None, None),
    ]
