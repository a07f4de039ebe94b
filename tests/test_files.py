import gzip
import json

import pytest
from conftest import bar, day, days, rows_of
from pyspark.sql import functions as F

from barflow.operators import ema as E
from barflow.operators import normalize as N
from barflow.plans import jobs
from barflow.schemas import BAR_COLUMNS, EMA_STATE_COLUMNS, ContractError
from barflow.sinks import publish as P
from barflow.sinks import writers as S
from barflow.sources import readers as R


def test_bars_round_trip_and_required_columns(bars, spark, tmp_path):
    df = bars([bar("A", d) for d in days("2024-01-01", 5)] + [bar("B", "2024-01-01")])
    path = str(tmp_path / "bars")
    assert S.write_bars(df, path).count() == 6
    assert rows_of(R.read_bars(spark, path)) == rows_of(df)
    assert R.read_bars(spark, path, df.filter("security_id = 'B'")).count() == 1
    with pytest.raises(ContractError):
        S.write_bars(df.limit(0), str(tmp_path / "empty"))
    df.drop("volume").write.parquet(str(tmp_path / "short"))
    with pytest.raises(ContractError, match="volume"):
        R.read_bars(spark, str(tmp_path / "short"))


def test_membership_documents(spark, tmp_path):
    def land(name, **changes):
        records = [
            {"security_id": "B", "ticker": "TB", "sharia_compliance": "COMPLIANT"},
            {"security_id": "A", "ticker": "TA", "sharia_compliance": "DOUBTFUL"},
        ]
        doc = {"snapshot_date": "2024-01-01", "count": 2, "records": records, **changes}
        (tmp_path / name).write_text(json.dumps(doc, indent=1))
        return str(tmp_path / name)

    ok = land("ok.json")
    assert rows_of(R.read_membership(spark, ok, "2024-01-01"), "security_id") == [("B",)]
    assert R.read_membership(spark, ok, only_eligible=False).count() == 2
    for name, changes in {
        "count.json": {"count": 3},
        "none.json": {"records": None},
        "blank.json": {"records": [{"security_id": "A"}], "count": 1},
        "twice.json": {"records": [{"security_id": "A", "ticker": "T"}] * 2},
    }.items():
        with pytest.raises(ContractError):
            R.read_membership(spark, land(name, **changes))
    with pytest.raises(ContractError, match="snapshot"):
        R.read_membership(spark, ok, "2024-02-01")


def test_symbol_directory(spark, tmp_path):
    listed = (
        "Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares\n"
        "AAA|Alpha|Q|N|N|100|N|N\nQQQ|Fund|G|N|N|100|Y|N\nFile Creation Time: 0101202421:31|||||||\n"
    )
    other = "ACT Symbol|Security Name|Exchange|CQS Symbol|ETF|Round Lot Size|Test Issue|NASDAQ Symbol\nIBX|Blue|N|IBX|N|100|Y|IBX\nFile Creation Time: 0101202421:31|||||||\n"
    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text(listed)
    b.write_text(other)
    out = R.read_symbol_directory(spark, str(a), str(b), "2024-01-01T00:00:00Z", "v1")
    assert rows_of(out, "symbol", "listing_exchange", "market_category", "is_etf", "test_issue", "source_file") == [
        ("AAA", "NASDAQ", "Q", "N", "N", "nasdaqlisted.txt"), ("IBX", "N", None, "N", "Y", "otherlisted.txt"),
        ("QQQ", "NASDAQ", "G", "Y", "N", "nasdaqlisted.txt"),
    ]
    b.write_text(other.replace("File Creation Time: 0101202421:31|||||||\n", ""))
    with pytest.raises(ContractError, match="trailer"):
        R.read_symbol_directory(spark, str(a), str(b), "t", "v1")
    b.write_text(other)
    a.write_text(listed.replace("QQQ", "AAA"))
    with pytest.raises(ContractError, match="duplicate"):
        R.read_symbol_directory(spark, str(a), str(b), "t", "v1")


def test_bulk_archive_judges_per_security(spark, tmp_path):
    head = "<TICKER>,<PER>,<DATE>,<TIME>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>,<OPENINT>\n"
    line = lambda d, o="10", h="11", v="5": f"X.US,D,{d},000000,{o},{h},9,10,{v},0\n"
    files = {
        "good.txt": line("20240102") + line("20240103") + line("20240103", v="7"),
        "date.txt": line("2024-01-02"),
        "null.txt": line("20240102", o="n/a"),
        "qc.txt": line("20240102") + line("20240103", h="9.5"),
        "skipped.txt": line("20240102"),
    }
    src = tmp_path / "src"
    src.mkdir()
    for name, text in files.items():
        (src / name).write_text(head + text)
    manifest = spark.createDataFrame(
        [("A", "TA", "COPIED", "good.txt"), ("B", "TB", "copied", "date.txt"), ("C", "TC", "COPIED", "null.txt"), ("D", "TD", "COPIED", "qc.txt"),
         ("E", "TE", "SKIPPED", "skipped.txt"), ("F", "TF", "COPIED", "absent.txt")],
        "security_id string, ticker string, status string, filename string",
    )
    out = R.read_bulk_archive(spark, str(src), manifest)
    assert dict(rows_of(out.select("security_id", "verdict").distinct())) == {
        "A": "staged", "B": "invalid_date", "C": "null_or_non_numeric", "D": "qc_rejected", "F": "missing_file",
    }
    (src / "good.txt").write_text("<TICKER>,<DATE>,<LOW>,<HIGH>,<OPEN>,<CLOSE>,<VOL>\nX.US,20240102,9,11,10,10,5\nX.US,20240103,9,11,10,10,7\n")
    out = R.read_bulk_archive(spark, str(src), manifest)
    assert rows_of(out.filter("security_id = 'A'"), "open", "low", "verdict") == [(10.0, 9.0, "staged")] * 2
    kept = out.filter("security_id = 'A'")
    assert rows_of(kept, "date", "close", "adj_close", "volume", "ticker") == [
        (day("2024-01-02"), 10.0, 10.0, 5, "TA"), (day("2024-01-03"), 10.0, 10.0, 7, "TA"),
    ]


def test_bulk_archive_opens_its_files_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("<TICKER>,<DATE>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>\nX.US,20240102,10,11,9,10,5\n")
    manifest = spark.createDataFrame([("A", "TA", "COPIED", "a.txt")], "security_id string, ticker string, status string, filename string")
    out = R.read_bulk_archive(spark, str(tmp_path), manifest)
    assert "FileScan text" not in out._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "a.txt").unlink()
    assert rows_of(out, "security_id", "close", "verdict") == [("A", 10.0, "staged")]


MANIFEST = "security_id string, ticker string, status string, filename string"


def test_bulk_archive_of_many_small_files_takes_few_tasks(spark, tmp_path):
    names = [f"T{i}" for i in range(120)]
    for name in names:
        (tmp_path / f"dir={name}").mkdir()
        (tmp_path / f"dir={name}" / "a.txt").write_text("<TICKER>,<DATE>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>\nX.US,20240102,10,11,9,10,5\n")
    manifest = spark.createDataFrame([(n, n, "COPIED", f"dir={n}/a.txt") for n in names], MANIFEST)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    context = spark.sparkContext
    context.setJobGroup("archive", "archive")
    try:
        out = R.read_bulk_archive(spark, str(tmp_path), manifest, path_parts=2)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("archive") for s in tracker.getJobInfo(job).stageIds}
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) < len(names)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert rows_of(out, "security_id", "close", "verdict") == sorted((n, 10.0, "staged") for n in names)


@pytest.mark.parametrize("whole", [R.WHOLE_FILE, 0])
def test_bulk_archive_lines_of_whole_long_and_packed_files(spark, tmp_path, monkeypatch, whole):
    monkeypatch.setattr(R, "WHOLE_FILE", whole)
    head, line = "<TICKER>,<DATE>,<OPEN>,<HIGH>,<LOW>,<CLOSE>,<VOL>", "X.US,2024010{},10,11,9,{},5"
    two = [line.format(2, 10), line.format(3, 9.5)]
    files = {
        "ends.txt": "\r\n".join([head, *two, ""]),
        "mark.txt": "\ufeff" + "\n".join([head[9:], *[x[5:] for x in two]]),
        "blank.txt": "\n".join(["", head, " , ,", two[0], head.lower().replace("date", "D<ATE"), "", two[1], "\n"]),
        "last.txt": "\n".join([head, line.format(2, 9), *two, line.format(3, 10)]),
        "short.txt": "\n".join([head, *two, "X.US,20240104"]),
    }
    src = tmp_path / "src"
    src.mkdir()
    for name, text in files.items():
        (src / name).write_bytes(text.encode())
    (src / "empty.txt").write_bytes(b"")
    (src / "packed.txt.gz").write_bytes(gzip.compress("\n".join([head, *two]).encode()))
    named = [*files, "empty.txt", "packed.txt.gz"]
    manifest = spark.createDataFrame([(n.split(".")[0], "T", "COPIED", n) for n in named] + [("again", "T", "COPIED", "ends.txt")], MANIFEST)
    out = R.read_bulk_archive(spark, str(src), manifest)
    sound = {n: [(day("2024-01-02"), 10.0, "staged"), (day("2024-01-03"), 9.5, "staged")] for n in ("ends", "mark", "blank", "again", "packed")}
    sound["last"] = [(day("2024-01-02"), 10.0, "staged"), (day("2024-01-03"), 10.0, "staged")]
    for name, rows in sound.items():
        assert rows_of(out.filter(F.col("security_id") == name), "date", "close", "verdict") == rows
    assert rows_of(out.filter("security_id IN ('empty', 'short')"), "security_id", "verdict") == [("empty", "missing_file")] + [("short", "null_or_non_numeric")] * 3
    (src / "unlisted.txt").write_text("<DATE>,<OPEN>\n20240102,10\n")
    with pytest.raises(ContractError, match="lacks columns"):
        R.read_bulk_archive(spark, str(src), manifest)
    (src / "unlisted.txt").write_text("no header\n")
    with pytest.raises(ContractError, match="lacks columns"):
        R.read_bulk_archive(spark, str(src), manifest)


@pytest.mark.parametrize("order", ["symbol_first", "field_first"])
def test_unpivot_provider(spark, order):
    name = (lambda s, f: f"{s}|{f}") if order == "symbol_first" else (lambda s, f: f"{f}|{s}")
    cells = {name(s, f): 1.0 + i for i, (s, f) in enumerate((s, f) for s in ("AA.B", "CC") for f in R.PROVIDER_NAMES)}
    absent = {k: (None if "CC" in k else v) for k, v in cells.items()}
    nan = {k: (float("nan") if "CC" in k else v) for k, v in cells.items()}
    rows = [(day("2024-01-02"), *cells.values()), (day("2024-01-03"), *absent.values()), (day("2024-01-04"), *nan.values())]
    wide = spark.createDataFrame(rows, "Date date, " + ", ".join(f"`{c}` double" for c in cells))
    out = R.unpivot_provider(wide)
    assert out.filter("symbol = 'CC'").count() == 1
    assert rows_of(out.filter("symbol = 'CC'"), "open", "volume") == [(7.0, 12.0)]
    assert out.filter("symbol = 'AA.B'").count() == 3
    with pytest.raises(ContractError):
        R.unpivot_provider(wide.select("Date"))


def test_parse_provider_json(spark):
    value = lambda d, **c: {"datetime": d, "open": "10", "high": "11", "low": "9", "close": "10", "volume": "5", **c}
    doc = lambda symbol, values, **c: json.dumps({"status": "ok", "meta": {"symbol": symbol}, "values": values, **c})
    landed = {
        "OK": doc("ok", [value("2024-01-03"), value("2024-01-02 00:00:00")]),
        "ERR": json.dumps({"status": "error", "code": 429}),
        "WHO": doc("OTHER", [value("2024-01-02")]),
        "TWICE": doc("TWICE", [value("2024-01-02"), value("2024-01-02")]),
        "TEXT": doc("TEXT", [value("2024-01-02", high="n/a")]),
        "DATE": doc("DATE", [value("soon")]),
        "NONE": doc("NONE", []),
        "JUNK": "not json",
    }
    df = spark.createDataFrame(list(landed.items()), "symbol string, payload string")
    out = R.parse_provider_json(df, "values")
    assert dict(rows_of(out.select("symbol", "verdict").distinct())) == {
        "OK": "accepted", "ERR": "response_error", "WHO": "identity_mismatch", "TWICE": "duplicate_dates", "TEXT": "qc_rejected",
        "DATE": "qc_rejected", "NONE": "empty", "JUNK": "response_error",
    }
    assert rows_of(out.filter("symbol = 'OK'"), "date", "close", "volume") == [(day("2024-01-02"), 10.0, 5.0), (day("2024-01-03"), 10.0, 5.0)]
    listing = json.dumps([{"date": "2024-01-02T00:00:00.000Z", "open": 10, "high": 11, "low": 9, "close": 10, "volume": 5, "adjClose": 9.5}])
    got = R.parse_provider_json(spark.createDataFrame([("L", listing), ("E", '{"detail": "no"}')], "symbol string, payload string"), "list")
    assert dict(rows_of(got, "symbol", "verdict")) == {"L": "accepted", "E": "response_error"}
    assert got.filter("symbol = 'L'").first()["adj_close"] == 9.5
    page = json.dumps({"bars": {"M": [{"t": "2024-01-02T05:00:00Z", "o": 10, "h": 11, "l": 9, "c": 10, "v": 5}], "N": []}})
    got = R.parse_provider_json(spark.createDataFrame([("page-1", page)], "symbol string, payload string"), "map")
    assert dict(rows_of(got, "symbol", "verdict")) == {"M": "accepted", "N": "empty"}
    lone = [("X", '{"message": "no"}'), ("Y", '{"bars": {}}')]
    got = R.parse_provider_json(spark.createDataFrame(lone, "symbol string, payload string"), "map")
    assert rows_of(got, "symbol", "verdict") == [("X", "response_error"), ("Y", "empty")]
    with pytest.raises(ValueError):
        R.parse_provider_json(df, "xml")


def test_failure_log_from_manifest_files(spark, tmp_path):
    def land(name, *results):
        doc = {"results": [dict(security_id=s, status=st, error=e, symbol="Y", ticker="T") for s, st, e in results]}
        (tmp_path / name).write_text(json.dumps(doc))

    land("run-1.json", ("A", "failed", "old"), ("B", "failed", "b"), ("C", "uploaded", None))
    land("run-2.json", ("A", "failed", "new"), ("D", "still_unavailable", "x"))
    land("repair-run-3.json", ("B", "still_unavailable", "gone"), ("E", "uploaded", None))
    log = R.latest_failure_log(R.manifest_results(spark, str(tmp_path)))
    assert rows_of(log, "security_id", "error", "manifest_key", "still_unavailable") == [
        ("A", "new", "run-2.json", False), ("B", "b", "run-1.json", True),
    ]


def test_lifecycle_registry(spark, tmp_path):
    path = tmp_path / "r.json"
    record = {"security_id": "A", "ticker": "T", "lifecycle_status": "X", "effective_date": "2026-09-02", "successor_ticker": None}
    path.write_text(json.dumps({"schema_version": 1, "records": [record]}))
    assert rows_of(R.read_lifecycle_registry(spark, str(path)), "security_id", "effective_date") == [("A", day("2026-09-02"))]
    for doc in ({"schema_version": 2, "records": [record]}, {"schema_version": 1, "records": [record, record]}):
        path.write_text(json.dumps(doc))
        with pytest.raises(ContractError):
            R.read_lifecycle_registry(spark, str(path))


def test_registry_documents(spark, tmp_path):
    def land(**doc):
        (tmp_path / "d.json").write_text(json.dumps(doc))
        return str(tmp_path / "d.json")

    plan = land(candidates=[{"security_id": "A", "ticker": "TA"}], deferred=[{"security_id": "B", "reason": "merged", "event_date": "2026-01-01"}])
    candidates, deferred = R.read_onboarding_plan(spark, plan)
    assert rows_of(candidates) == [("A", "TA")] and rows_of(deferred, "security_id", "reason") == [("B", "merged")]
    with pytest.raises(ContractError):
        R.read_onboarding_plan(spark, land(candidates=[], deferred=[{"security_id": "B"}, {"security_id": "B"}]))
    review = dict(security_id="A", ticker="TA", scope="market_data", snapshot_date="s", reviewed_at="r", finding="f", source_url="https://e.org/x", resolution="FOLLOW_UP_REQUIRED")
    assert R.read_review_registry(spark, land(schema_version=1, records=[review])).count() == 1
    for broken in ({"source_url": "ftp://e.org"}, {"finding": ""}, {"resolution": "DONE"}):
        with pytest.raises(ContractError):
            R.read_review_registry(spark, land(schema_version=1, records=[review | broken]))
    with pytest.raises(ContractError):
        R.read_review_registry(spark, land(schema_version=1))
    q = R.read_quarantine(spark, land(quarantined_ready=[{"ready_as_of_date": "d", "ready_sha256": "f", "last_known_good_as_of_date": "g"}]))
    assert rows_of(q) == [("d", "f", "g")]


def test_benchmark_job(bars, spark, tmp_path):
    root = str(tmp_path / "bench")
    ordered = lambda rows: bars(rows).withColumn("src_ord", F.unix_date("date"))
    rows = [bar("K", d, 100.0 + i) for i, d in enumerate(days("2024-01-01", 10))]
    first = jobs.update_benchmark(spark, ordered(rows[:6]), root, day("2024-01-05"))
    assert (first.decision, first.pointer.rows) == ("CREATE", 5)
    assert jobs.update_benchmark(spark, ordered(rows[2:6]), root, day("2024-01-05")).decision == "REUSE"
    halved = [r | {"adj_close": r["close"] / 2} for r in rows[2:8]] + [bar("K", "2024-01-09", close=None)]
    second = jobs.update_benchmark(spark, ordered(halved), root, day("2024-01-31"))
    data, pointer = P.load_snapshot(spark, root)
    assert pointer == second.pointer and pointer.rows == 8
    assert [c for _, c in rows_of(data, "date", "adj_close")] == [r["close"] / 2 for r in rows[:8]]
    same_day = [r | {"volume": 7, "adj_close": r["close"] / 2} for r in rows[6:8]]
    assert jobs.update_benchmark(spark, ordered(same_day), root, day("2024-01-31")).decision == "CREATE"
    for bad, message in [
        ([r | {"close": r["close"] + 0.5} for r in rows[6:9]], "continuity"),
        ([rows[8], rows[8]], "repeated"),
        ([rows[7], rows[8] | {"high": 1.0}], "rejected"),
        ([rows[9]], "continuity"),
    ]:
        with pytest.raises(ContractError, match=message):
            jobs.update_benchmark(spark, ordered(bad), root, day("2024-01-31"))


def test_incremental_start(spark):
    assert str(spark.range(1).select(R.incremental_start(day("2024-01-10"))).first()[0]) == "2024-01-03"


def test_upsert_daily_touches_only_its_dates(bars, spark, tmp_path):
    path = str(tmp_path / "daily")
    S.upsert_daily(spark, path, bars([bar(s, d) for s in "AB" for d in ("2024-01-01", "2024-01-02")]), "volume")
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "daily" / "date=2024-01-01").iterdir()}
    done = S.upsert_daily(spark, path, bars([bar("B", "2024-01-02", 20.0), bar("C", "2024-01-02"), bar("C", "2024-01-03")]), "volume")
    assert rows_of(done) == [(day("2024-01-02"), 3), (day("2024-01-03"), 1)]
    out = dict(((r["security_id"], str(r["date"])), r["close"]) for r in R.read_bars(spark, path).collect())
    assert len(out) == 6 and out[("B", "2024-01-02")] == 20.0
    assert {f.name: f.stat().st_mtime_ns for f in (tmp_path / "daily" / "date=2024-01-01").iterdir()} == before


def test_issue_csv(bars, spark, tmp_path):
    bad = N.qc_bad_bars(bars([bar("A", "2024-01-01", volume=-1, high=1.0), bar("B", "2024-01-01")]))
    S.write_issue_csv(bad, str(tmp_path / "csv"))
    got = spark.read.option("header", "true").csv(str(tmp_path / "csv")).collect()
    assert [r["issues"].split("|")[0] for r in got] == ["negative_volume"]


def test_fingerprint_is_order_free_and_content_bound(bars):
    rows = [bar(s, d, 10.0 + i) for i, d in enumerate(days("2024-01-01", 30)) for s in "AB"]
    rows[0] = rows[0] | {"close": None}
    df = bars(rows)
    n, f = P.fingerprint(df, BAR_COLUMNS)
    assert (n, f) == P.fingerprint(df.repartition(5).orderBy(F.rand(1)), BAR_COLUMNS)
    frame = P.fingerprint_frame(df, BAR_COLUMNS).first()
    assert (frame["rows"], frame["fingerprint"]) == (n, f)
    other = [
        df.withColumn("volume", F.col("volume") + (F.col("date") == day("2024-01-05")).cast("long")),
        df.union(df.limit(1)),
        df.filter("not (security_id = 'A' and date = '2024-01-03')"),
        df.fillna(0.0),
    ]
    assert f not in {P.fingerprint(x, BAR_COLUMNS)[1] for x in other}
    assert P.fingerprint(df.limit(0), BAR_COLUMNS)[0] == 0


def test_fingerprint_sums_are_those_of_the_hashed_slices(bars):
    df = bars([bar(s, d) for d in days("2024-01-01", 9) for s in "AB"])
    texts = [r[0] for r in df.select(F.sha2(F.to_json(F.struct(*BAR_COLUMNS), {"ignoreNullFields": "false"}), 256)).collect()]
    sums = df.agg(*P.fingerprint_aggregates(BAR_COLUMNS)).first()
    assert [int(sums[f"h{i}"]) for i in range(4)] == [sum(int(t[15 * i : 15 * i + 15], 16) for t in texts) for i in range(4)]
    assert dict(df.agg(*P.fingerprint_aggregates(BAR_COLUMNS)).dtypes)["h0"] == "decimal(38,0)"


def test_publication_protocol(bars, spark, tmp_path):
    root = str(tmp_path / "ready")
    snap = lambda last, close=10.0: bars([bar(s, d, close) for s in "AB" for d in days("2024-01-01", last)])
    assert P.read_pointer(spark, root) is None
    with pytest.raises(FileNotFoundError):
        P.load_snapshot(spark, root)
    first = P.publish_snapshot(spark, snap(3), root, day("2024-01-03"))
    assert (first.decision, first.pointer.rows, first.pointer.securities) == ("CREATE", 6, 2)
    assert P.publish_snapshot(spark, snap(3).orderBy(F.desc("date")), root, day("2024-01-03")).decision == "REUSE"
    with pytest.raises(ContractError, match="mutation"):
        P.publish_snapshot(spark, snap(3, 11.0), root, day("2024-01-03"))
    with pytest.raises(ContractError, match="rollback"):
        P.publish_snapshot(spark, snap(2), root, day("2024-01-02"))
    assert P.read_pointer(spark, root) == first.pointer
    fixed = P.publish_snapshot(spark, snap(3, 11.0), root, day("2024-01-03"), recovery=True)
    assert "-recovery-" in fixed.pointer.path and fixed.pointer.previous_path == first.pointer.path
    data, pointer = P.load_snapshot(spark, root)
    assert pointer.seq == 2 and rows_of(data) == rows_of(snap(3, 11.0))
    assert spark.read.parquet(first.pointer.path).count() == 6  # the earlier run is untouched


def test_left_over_run_is_adopted_or_refused(bars, spark, tmp_path):
    root = str(tmp_path / "ready")
    df = bars([bar("A", d) for d in days("2024-01-01", 3)])
    df.write.parquet(f"{root}/runs/2024-01-03")
    with pytest.raises(ContractError, match="does not hold"):
        P.publish_snapshot(spark, df.limit(2), root, day("2024-01-03"))
    assert P.publish_snapshot(spark, df, root, day("2024-01-03")).decision == "CREATE"


def test_unfinished_run_does_not_block_its_date(bars, spark, tmp_path):
    root = str(tmp_path / "ready")
    df = bars([bar("A", d) for d in days("2024-01-01", 3)])
    df.limit(2).write.parquet(f"{root}/runs/2024-01-03")
    (tmp_path / "ready" / "runs" / "2024-01-03" / "_SUCCESS").unlink()
    done = P.publish_snapshot(spark, df, root, day("2024-01-03"))
    assert done.decision == "CREATE" and done.pointer.path != f"{root}/runs/2024-01-03"
    assert rows_of(P.load_snapshot(spark, root)[0]) == rows_of(df)
    assert spark.read.parquet(f"{root}/runs/2024-01-03").count() == 2  # what the attempt left is untouched


def test_load_rejects_tampered_content_and_late_dates(bars, spark, tmp_path):
    root = str(tmp_path / "ready")
    df = bars([bar("A", d) for d in days("2024-01-01", 3)])
    P.publish_snapshot(spark, df, root, day("2024-01-03"))
    df.limit(1).write.mode("append").parquet(f"{root}/runs/2024-01-03")
    with pytest.raises(ContractError, match="content"):
        P.load_snapshot(spark, root)
    late = str(tmp_path / "late")
    P.publish_snapshot(spark, df, late, day("2024-01-02"))
    with pytest.raises(ContractError, match="terminal"):
        P.load_snapshot(spark, late)


def test_ready_defers_harmless_same_day_changes(bars, spark, tmp_path):
    root = str(tmp_path / "ready")
    rows = [bar(s, d) for s in "ABD" for d in days("2024-01-02", 3)] + [bar("C", d) for d in days("2024-01-01", 3)]
    assert P.publish_ready(spark, bars(rows), root).decision == "CREATE"
    moved = [r for r in rows if (r["security_id"], r["date"]) != ("C", day("2024-01-01"))] + [bar("C", "2024-01-04")]
    assert P.publish_ready(spark, bars(moved), root).decision == "DEFERRED"
    assert P.publish_ready(spark, bars([r for r in rows if r["security_id"] != "A"]), root).decision == "DEFERRED"
    with pytest.raises(ContractError):
        P.publish_ready(spark, bars([r | {"volume": 1} for r in rows]), root)
    with pytest.raises(ContractError, match="leading"):
        P.publish_ready(spark, bars([*rows, bar("A", "2024-01-05")]), root)
    assert P.publish_ready(spark, bars([r | {"volume": 1} for r in rows]), root, quarantined=True).decision == "CREATE"


def test_ready_job_gates(bars, spark, tmp_path):
    rows = [bar(s, d) for s in "ABC" for d in days("2024-01-01", 6)]
    gapped = [r for r in rows if (r["security_id"], r["date"]) != ("B", day("2024-01-05"))]
    from barflow.operators import windows as W

    def run(data, name, **kw):
        df = bars(data)
        detail = W.readiness(df.select("security_id", "ticker").distinct(), df, None, 6, 4)
        return jobs.publish_ready_snapshot(spark, df, detail, str(tmp_path / name), kw.pop("cutoff", day("2024-01-06")), 4, 6, **kw)

    assert run(rows, "a", previous_as_of=day("2024-01-03")).pointer.rows == 18
    assert run(gapped, "b").decision == "CREATE"
    with pytest.raises(ContractError, match="continuity"):
        run(gapped, "c", previous_as_of=day("2024-01-03"))
    with pytest.raises(ContractError, match="coverage"):
        run(rows, "d", cutoff=day("2024-01-03"))
    with pytest.raises(ContractError, match="rows rejected"):
        run([rows[0] | {"high": 1.0}, *rows[1:]], "e")


def test_ema_promotion_needs_equivalence(bars, spark, tmp_path):
    rows = [bar("A", d, 100.0 + i % 9) for i, d in enumerate(days("2023-01-01", 260))]
    root = str(tmp_path / "ema")
    ready = bars(rows[-60:])
    last = rows[-1]["date"]
    done = jobs.build_and_promote_ema(spark, ready, "fp", bars(rows), None, root, str(tmp_path / "cand"), last)
    assert done.decision == "CREATE" and done.pointer.source_fingerprint == "fp"
    want = rows_of(E.bootstrapped(bars(rows)))
    assert rows_of(P.load_ema_state(spark, root, "fp"), *EMA_STATE_COLUMNS) == want
    with pytest.raises(ContractError, match="another source"):
        P.load_ema_state(spark, root, "other")
    state = E.bootstrapped(bars(rows)).withColumn("ema20", F.col("ema20") * 2)
    report = E.ema_equivalence_report(E.ema_equivalence(state, bars(rows), state, last))
    with pytest.raises(ContractError, match="equivalence"):
        P.promote_ema(spark, state, report, root, last, "fp")


def test_one_bad_cell_does_not_stop_a_reader(spark, tmp_path):
    path = str(tmp_path / "bars")
    rows = [("2024-01-02", "A", "T", "n/a", "11", "9", "10", "10", "5"), ("never", "A", "T", "10", "11", "9", "10", "10", "5")]
    spark.createDataFrame(rows, "date string, security_id string, ticker string, open string, high string, low string, close string, adj_close string, volume string").write.parquet(path)
    assert rows_of(R.read_bars(spark, path), "open", "high") == [(None, 11.0)]
    wide = spark.createDataFrame([("2024-01-02", "x", "2")], "Date string, `A|Open` string, `A|Close` string")
    assert rows_of(R.unpivot_provider(wide), "symbol", "open", "close") == [("A", None, 2.0)]


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    from barflow import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ContractError, match="shared folder"):
        session.shared_folder(Cluster())
    Cluster.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ContractError, match="shared folder"):
        session.shared_folder(Cluster())


def test_ready_job_trusts_only_the_right_predecessor(bars, spark, tmp_path):
    from barflow.operators import windows as W

    none = spark.createDataFrame([], "as_of_date string, fingerprint string, last_known_good string")
    root = str(tmp_path / "ready")

    def run(rows, cutoff, quarantine=none, listed=2):
        df = bars(rows)
        members = df.select("security_id", "ticker").distinct()
        return jobs.ready_job(spark, df, W.readiness(members, df, None, 6, 4), members, listed, 2, quarantine, root, cutoff, 4, 6)

    rows = [bar(s, d) for s in "AB" for d in days("2024-01-01", 6)]
    with pytest.raises(ContractError, match="list rejected"):
        run(rows, day("2024-01-06"), listed=3)
    first = run(rows, day("2024-01-06")).pointer
    later = [bar(s, d) for s in "AB" for d in days("2024-01-03", 6) if (s, d) != ("B", day("2024-01-07"))]
    with pytest.raises(ContractError, match="continuity"):
        run(later, day("2024-01-08"))
    bad = spark.createDataFrame([(first.as_of_date, first.fingerprint, None)], none.schema)
    with pytest.raises(ContractError, match="predecessor rejected"):
        run(rows, day("2024-01-06"), bad)
    with pytest.raises(ContractError, match="changed while"):
        df = bars(rows)
        detail = W.readiness(df.select("security_id", "ticker").distinct(), df, None, 6, 4)
        jobs.publish_ready_snapshot(spark, df, detail, str(tmp_path / "x"), day("2024-01-06"), 4, 6, source_unchanged=lambda: False)


def test_ema_state_is_refused_without_its_evidence(bars, spark, tmp_path):
    import dataclasses

    rows = [bar("A", d, 100.0 + i % 9) for i, d in enumerate(days("2023-01-01", 260))]
    root = str(tmp_path / "ema")
    done = jobs.build_and_promote_ema(spark, bars(rows[-60:]), "fp", bars(rows), None, root, str(tmp_path / "cand"), rows[-1]["date"])
    assert P.ema_evidence_issues(done.pointer) == []
    held = json.loads(done.pointer.evidence)
    for name in ("price_basis", "periods", "policy", "equivalence"):
        broken = dataclasses.replace(done.pointer, evidence=json.dumps({k: v for k, v in held.items() if k != name}))
        assert P.ema_evidence_issues(broken)
    failing = {**held, "equivalence": {**held["equivalence"], "numeric_failures": 1}}
    assert P.ema_evidence_issues(dataclasses.replace(done.pointer, evidence=json.dumps(failing))) == ["numeric_failures"]
    assert "source_fingerprint" in P.ema_evidence_issues(dataclasses.replace(done.pointer, source_fingerprint=None))
    P.publish_snapshot(spark, E.bootstrapped(bars(rows)), str(tmp_path / "bare"), rows[-1]["date"], EMA_STATE_COLUMNS, "as_of_date", "fp")
    with pytest.raises(ContractError, match="evidence"):
        P.load_ema_state(spark, str(tmp_path / "bare"))


def test_daily_update_is_written_behind_its_gate(bars, spark, tmp_path):
    root = str(tmp_path)
    history = bars([bar(s, d) for s in "AB" for d in days("2024-01-01", 3)])
    history.write.parquet(f"{root}/history")
    stored = R.read_bars(spark, f"{root}/history")
    members = spark.createDataFrame([("A", "TA"), ("B", "TB")], "security_id string, ticker string")
    life = spark.createDataFrame(
        [("B", "TB", "VERIFIED_TICKER_CHANGE_SAME_SECURITY", day("2024-01-02"), "r", None, "NEW")], R.LIFECYCLE
    )
    fetched = bars([bar(s, d) for s in "AB" for d in days("2024-01-03", 2)]).withColumn("src_ord", F.lit(1))
    update = jobs.daily_update(members, stored, fetched, fetched.limit(0), life, day("2024-01-04"), 3, 2)
    jobs.write_daily_update(spark, update, root)
    rolling = spark.read.parquet(f"{root}/rolling")
    assert rows_of(rolling, "security_id", "date", "ticker") == [(s, d, t) for s, t in (("A", "TA"), ("B", "NEW")) for d in days("2024-01-02", 3)]
    assert R.read_bars(spark, f"{root}/history").count() == 8
    assert R.read_bars(spark, f"{root}/daily").count() == 2
    broken = jobs.daily_update(members, stored, fetched.withColumn("high", F.lit(1.0)), fetched.limit(0), life, day("2024-01-04"), 3, 2)
    with pytest.raises(ContractError, match="refused"):
        jobs.write_daily_update(spark, broken, root)


def test_stored_history_is_laid_out_by_year_and_security(bars, spark, tmp_path):
    rows = [bar(s, d) for s in "ABCDEFGH" for d in days("2020-01-01", 60, 30)]
    path = str(tmp_path / "bars")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        S.write_bars(bars(rows), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.min(F.year("date")).alias("a"), F.max(F.year("date")).alias("b")).collect()
    assert len(spans) > 2 and all(r["b"] - r["a"] <= 2 for r in spans)
