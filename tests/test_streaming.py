import datetime as dt
import random

from conftest import bar, day, days, rows_of
from pyspark.sql import functions as F

from barflow.operators import ema as E
from barflow.operators import snapshots as S
from barflow.schemas import BARS, EMA_STATE_COLUMNS
from barflow.streaming import streams as T


def test_daily_bars_stream_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    ticks = [(rng.randrange(3), start + dt.timedelta(minutes=rng.randrange(5 * 1440)), i, rng.random()) for i in range(600)]
    df = spark.createDataFrame(ticks, T.TICKS)
    for part in range(4):
        df.filter(f"event_id % 4 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = T.read_files_as_stream(spark, str(tmp_path / "in"), T.TICKS, files_per_trigger=1)
    out = T.stream_daily_bars(stream, str(tmp_path / "run"))
    assert rows_of(out) == rows_of(T.daily_bars(df))


def test_no_tick_is_too_late(spark, tmp_path):
    ticks = [(1, dt.datetime(2024, 1, d, h), n, float(v)) for n, (d, h, v) in enumerate([(1, 9, 1), (9, 9, 2), (10, 9, 3), (11, 9, 4), (1, 15, 5), (9, 8, 6)])]
    df = spark.createDataFrame(ticks, T.TICKS)
    for part in range(len(ticks)):
        df.filter(f"event_id = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = T.read_files_as_stream(spark, str(tmp_path / "in"), T.TICKS, files_per_trigger=1)
    out = T.stream_daily_bars(stream, str(tmp_path / "run"))
    assert rows_of(out) == rows_of(T.daily_bars(df))
    assert rows_of(out.filter("date = '2024-01-01'"), "open", "close", "volume") == [(1.0, 5.0, 2)]


def land(bars, path, *deliveries):
    for rows in deliveries:
        bars(rows).coalesce(1).write.mode("append").parquet(path)


def test_ema_stream_equals_batch_and_sets_odd_rows_aside(bars, spark, tmp_path):
    rows = {s: [bar(s, d, 50.0 + (i * k) % 11) for i, d in enumerate(days("2023-01-01", 260))] for s, k in (("A", 3), ("B", 7))}
    state = E.bootstrapped(bars([r for s in "AB" for r in rows[s][:220]]))
    path = str(tmp_path / "in")
    land(bars, path, rows["A"][220:240] + rows["B"][220:225], rows["A"][240:260] + [bar("NEW", "2024-01-01")], rows["B"][225:260] + [rows["A"][230]])
    stream = T.read_files_as_stream(spark, path, BARS, files_per_trigger=1)
    out = T.stream_ema(stream, state, str(tmp_path / "run"))
    assert rows_of(out, *EMA_STATE_COLUMNS) == rows_of(E.bootstrapped(bars(rows["A"] + rows["B"])))
    side = spark.read.parquet(str(tmp_path / "run" / "side"))
    assert rows_of(side, "security_id", "side") == [("A", "late"), ("NEW", "unknown_security")]


def test_ema_stream_resumes_after_a_stop(bars, spark, tmp_path):
    rows = [bar("A", d, 50.0 + (i * 3) % 11) for i, d in enumerate(days("2023-01-01", 240))]
    state = E.bootstrapped(bars(rows[:210]))
    path, run = str(tmp_path / "in"), str(tmp_path / "run")
    land(bars, path, rows[210:220])
    read = lambda: T.read_files_as_stream(spark, path, BARS, files_per_trigger=1)
    T.stream_ema(read(), state, run)
    land(bars, path, rows[220:230], rows[230:240])
    out = T.stream_ema(read(), state, run)
    assert rows_of(out) == rows_of(E.bootstrapped(bars(rows)))
    assert rows_of(T.stream_ema(read(), state, run)) == rows_of(out)  # nothing new to read


def test_ema_stream_holds_unusable_bars(bars, spark, tmp_path):
    rows = [bar("A", d) for d in days("2023-01-01", 210)]
    state = E.bootstrapped(bars(rows))
    land(bars, str(tmp_path / "in"), [bar("A", "2024-01-01", adj_close=-1.0)])
    out = T.stream_ema(T.read_files_as_stream(spark, str(tmp_path / "in"), BARS), state, str(tmp_path / "run"))
    assert rows_of(out) == rows_of(state)
    assert rows_of(spark.read.parquet(str(tmp_path / "run" / "held")), "security_id", "reason") == [("A", "invalid_source")]


def test_undated_ticks_are_set_aside_in_both_forms(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, 9)
    df = spark.createDataFrame([(1, at, 0, 5.0), (1, None, 1, 9.0), (2, None, 2, 1.0)], T.TICKS)
    df.write.parquet(str(tmp_path / "in"))
    out = T.stream_daily_bars(T.read_files_as_stream(spark, str(tmp_path / "in"), T.TICKS), str(tmp_path / "run"))
    assert rows_of(out) == rows_of(T.daily_bars(df)) == [(1, at.date(), 5.0, 5.0, 5.0, 5.0, 1)]
    assert rows_of(spark.read.parquet(str(tmp_path / "run" / "undated")), "event_id") == [(1,), (2,)]


def test_partial_bars_are_compacted(spark, tmp_path):
    rng = random.Random(7)
    ticks = [(rng.randrange(3), dt.datetime(2024, 1, 1 + rng.randrange(4), rng.randrange(24)), i, rng.random()) for i in range(90)]
    df = spark.createDataFrame(ticks, T.TICKS)
    for part in range(5):
        df.filter(f"event_id % 5 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = T.read_files_as_stream(spark, str(tmp_path / "in"), T.TICKS, files_per_trigger=1)
    out = T.stream_daily_bars(stream, str(tmp_path / "run"), compact_every=2)
    assert rows_of(out) == rows_of(T.daily_bars(df))
    assert sorted(p.name for p in (tmp_path / "run" / "parts").iterdir()) == ["2", "3", "4"]


def shuffled(rows, parts, seed):
    rng = random.Random(seed)
    dealt = [[] for _ in range(parts)]
    for row in rows:
        dealt[rng.randrange(parts)].append(row)
    return [d for d in dealt if d]


def test_ema_stream_in_any_order_equals_batch(bars, spark, tmp_path):
    series = {s: [bar(s, d, 50.0 + (i * k) % 11) for i, d in enumerate(days("2023-01-01", 230))] for s, k in (("A", 3), ("B", 7))}
    new = [bar("C", d, 20.0 + i % 5) for i, d in enumerate(days("2023-02-01", 210))]
    start = [r for rows in series.values() for r in rows[:200]]
    rest = [r for rows in series.values() for r in rows[200:]] + new
    path, run, history = str(tmp_path / "in"), str(tmp_path / "run"), bars(start)
    deliveries = shuffled(rest, 5, 3)
    read = lambda: T.read_files_as_stream(spark, path, BARS, files_per_trigger=1)
    go = lambda: T.stream_ema(read(), E.bootstrapped(history), run, history=history, compact_every=2)
    land(bars, path, *deliveries[:3])
    go()
    # after a stop the rest arrives, with bars that were there before
    land(bars, path, *deliveries[3:], [dict(r, adj_close=1.0) for r in start[:3]])
    out = go()
    assert rows_of(out) == rows_of(E.bootstrapped(bars(start + rest)))
    held = rows_of(spark.read.parquet(f"{run}/held"), "security_id", "reason")
    assert {h for h in held} == {("C", "too_few_bars")}


def test_ema_stream_folds_history_once(bars, spark, tmp_path, monkeypatch):
    """Deliveries of mixed dates later than history rebuild their securities from its one bootstrap."""
    series = {s: [bar(s, d, 50.0 + (i * k) % 11) for i, d in enumerate(days("2023-01-01", 230))] for s, k in (("A", 3), ("B", 7))}
    start = [r for rows in series.values() for r in rows[:200]]
    rest = [r for rows in series.values() for r in rows[200:]]
    folds, fold, history = [], T.ema_bootstrap, bars(start)
    monkeypatch.setattr(T, "ema_bootstrap", lambda *a: folds.append(1) or fold(*a))
    land(bars, str(tmp_path / "in"), *shuffled(rest, 3, 4))
    stream = T.read_files_as_stream(spark, str(tmp_path / "in"), BARS, files_per_trigger=1)
    out = T.stream_ema(stream, E.bootstrapped(history), str(tmp_path / "run"), history=history)
    assert rows_of(out) == rows_of(E.bootstrapped(bars(start + rest)))
    assert len(folds) == 1


def test_ema_stream_writes_what_changed(bars, spark, tmp_path):
    ids = [f"S{i:02d}" for i in range(20)]
    rows = [bar(s, d, 30.0 + i % 7) for s in ids for i, d in enumerate(days("2023-01-01", 200))]
    late = [bar(s, "2023-12-01", 31.0) for s in ("S03", "S07")]
    land(bars, str(tmp_path / "in"), late)
    stream = T.read_files_as_stream(spark, str(tmp_path / "in"), BARS)
    out = T.stream_ema(stream, E.bootstrapped(bars(rows)), str(tmp_path / "run"))
    assert rows_of(out) == rows_of(E.bootstrapped(bars(rows + late)))
    changes = spark.read.parquet(str(tmp_path / "run" / "changes" / "0"))
    assert rows_of(changes, "security_id") == [("S03",), ("S07",)]


def test_ema_stream_refuses_repeats_and_keeps_the_state(bars, spark, tmp_path):
    rows = [bar("A", d) for d in days("2023-01-01", 205)]
    state, history = E.bootstrapped(bars(rows)), bars(rows)
    twice = [bar("A", "2024-01-02", 11.0), bar("A", "2024-01-02", 12.0), bar("A", None)]
    land(bars, str(tmp_path / "in"), twice)
    out = T.stream_ema(T.read_files_as_stream(spark, str(tmp_path / "in"), BARS), state, str(tmp_path / "run"), history=history)
    assert rows_of(out) == rows_of(state)
    assert rows_of(spark.read.parquet(str(tmp_path / "run" / "held")), "security_id", "reason") == [("A", "duplicate_dates")]
    assert rows_of(spark.read.parquet(str(tmp_path / "run" / "side")), "side") == [("no_date",)]


def test_finalize_stream_classes(bars, spark, tmp_path):
    land(bars, str(tmp_path / "in"), [bar("A", d) for d in days("2024-01-01", 3)], [bar("A", d) for d in days("2024-01-04", 3)])
    stream = T.read_files_as_stream(spark, str(tmp_path / "in"), BARS)
    out = T.stream_finalize(stream, str(tmp_path / "run"), day("2024-01-05"), day("2024-01-02"))
    assert rows_of(out, "date", "stream_class") == [
        (d, c) for d, c in zip(days("2024-01-01", 6), ["late", "late", "final", "final", "final", "not_final"])
    ]


def test_late_rows_of_several_snapshots_are_judged_by_each(bars, spark, tmp_path):
    """Two snapshots, one of which holds a key twice: the same rows as of each snapshot by itself, stored once a bar."""
    one, other = day("2024-01-06"), day("2024-01-12")
    epochs = {
        one: bars([bar("A", d) for d in days("2024-01-02", 4)] + [bar("A", "2024-01-03", 12.0)]),
        other: bars([bar(s, d) for s in "AB" for d in days("2024-01-04", 5)]),
    }
    first = [bar("A", d) for d in days("2024-01-01", 12)] + [bar("B", "2024-01-05"), bar("C", "2024-01-02"), bar("A", None), bar(None, "2024-01-02")]
    second = [bar("A", "2024-01-03"), bar("B", "2024-01-06", 3.0), bar("B", "2024-01-07"), bar("B", "2024-01-07")]
    land(bars, str(tmp_path / "in"), first, second)
    stream = T.read_files_as_stream(spark, str(tmp_path / "in"), BARS, files_per_trigger=1)
    side = T.stream_late_arrivals(stream, epochs, str(tmp_path / "run"), 5)
    sent = bars(first).withColumn("delivery", F.lit(0).cast("long")).unionByName(bars(second).withColumn("delivery", F.lit(1).cast("long")))
    alone = [r for day_, epoch in epochs.items() for r in rows_of(S.late_arrivals(epoch, sent, day_, 5))]
    assert rows_of(side) == sorted(alone, key=repr)
    assert sum(r[0] == one and r[2] == day("2024-01-03") for r in alone) == 4
    # each bar is written once for both snapshots
    assert spark.read.parquet(str(tmp_path / "run" / "late" / "0")).filter("date = '2024-01-02'").count() == 2


def test_late_rows_get_the_reason_of_the_snapshot_diff(bars, spark, tmp_path):
    as_of, window = day("2024-01-12"), 5
    epoch = [bar("A", d) for d in days("2024-01-02", 5, 2)] + [bar("B", d) for d in days("2024-01-03", 3)]
    rows = [
        bar("A", "2024-01-05"), bar("A", "2024-01-01"), bar("A", "2024-01-04", 99.0), bar("A", "2024-01-06"),
        bar("B", "2024-01-09"), bar("NEW", "2024-01-09"), bar("A", "2024-01-12"), bar("A", "2024-02-01"),
    ]
    path, epochs = str(tmp_path / "in"), {as_of: bars(epoch)}
    land(bars, path, rows[:3], rows[3:], [rows[0]])
    stream = T.read_files_as_stream(spark, path, BARS, files_per_trigger=1)
    side = T.stream_late_arrivals(stream, epochs, str(tmp_path / "run"), window)
    got = {(r.security_id, r.date, r.delivery): (r.reason, r.detail) for r in side.collect()}
    assert len(got) == 8 and got.pop(("A", day("2024-01-05"), 2)) == ("duplicate_keys", None)
    assert got[("A", day("2024-01-04"), 0)] == ("overlap_values_changed", "open")
    assert got[("A", day("2024-01-01"), 0)] == ("not_balanced_window_shift", "before_window")
    assert got[("A", day("2024-01-06"), 1)] == ("not_balanced_window_shift", "equal_bar")
    # each reason is that of the snapshot beside a candidate that takes in the row alone
    for row in rows[:-1]:
        after = {(r["security_id"], r["date"]): r for r in [*epoch, row]}
        mine = sorted((r for r in after.values() if r["security_id"] == row["security_id"]), key=lambda r: r["date"])[-window:]
        others = [r for r in after.values() if r["security_id"] != row["security_id"]]
        verdict = S.window_advance_diff(epochs[as_of], bars(mine + others), as_of).first()
        key = next(k for k in got if k[:2] == (row["security_id"], row["date"]))
        assert got[key][0] == verdict["reason"], row
    # the stream equals the comparison of all deliveries at once
    again = bars(rows[:3]).withColumn("delivery", F.lit(0).cast("long"))
    for n, part in ((1, rows[3:]), (2, [rows[0]])):
        again = again.unionByName(bars(part).withColumn("delivery", F.lit(n).cast("long")))
    assert rows_of(side) == rows_of(S.late_arrivals(epochs[as_of], again, as_of, window))
