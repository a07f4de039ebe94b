import pytest
from conftest import bar, day, days, rows_of

from barflow.schemas import BAR_COLUMNS, ContractError
from barflow.sinks import repair as R

DAY = day("2024-01-05")


class Stopped(Exception):
    pass


def history(bars):
    rows = [bar(f"S{i}", d, 10.0 + i) for i in range(12) for d in days("2024-01-01", 10) if not (i == 3 and d == DAY)]
    return bars(rows)


def fresh_of(bars):
    rows = [bar(f"S{i}", DAY, 50.0 + i) for i in range(8)]
    rows += [bar("S8", DAY, 1.0), bar("S8", DAY, 2.0), bar("S9", DAY, None), bar("S10", DAY, 20.0), bar("S1", "2024-01-06", 99.0)]
    return bars(rows)


def run(spark, bars, root, stop=None):
    wanted = history(bars).select("security_id")
    return R.repair_session(spark, f"{root}/h", fresh_of(bars), DAY, f"{root}/log", 5, 2, wanted, stop)


def wanted_rows(bars):
    old = {(r.security_id, r.date): r for r in history(bars).collect()}
    for r in fresh_of(bars).collect():
        if r.date == DAY and r.security_id in {f"S{i}" for i in range(8)}:
            old[(r.security_id, r.date)] = r
    return sorted((tuple(r[c] for c in BAR_COLUMNS) for r in old.values()), key=repr)


ACTIONS = sorted(
    [(f"S{i}", "changed") for i in (0, 1, 2, 4, 5, 6, 7)]
    + [("S3", "added"), ("S8", "not_exactly_one_row"), ("S9", "unsound_bar"), ("S10", "same"), ("S11", "missing_source")],
    key=repr,
)


def test_stopped_after_any_step(bars, spark, tmp_path):
    steps = []
    R.write_parts(history(bars), str(tmp_path / "first" / "h"), 5)
    report = run(spark, bars, str(tmp_path / "first"), steps.append)
    assert rows_of(report, "security_id", "action") == ACTIONS
    assert rows_of(R.read_parts(spark, str(tmp_path / "first" / "h")), *BAR_COLUMNS) == wanted_rows(bars)
    assert len(steps) >= 8
    for at in steps:
        root = str(tmp_path / at.replace(" ", "-"))
        R.write_parts(history(bars), f"{root}/h", 5)

        def stop(name, at=at):
            if name == at:
                raise Stopped

        with pytest.raises(Stopped):
            run(spark, bars, root, stop)
        seen = []
        assert rows_of(run(spark, bars, root, seen.append), "security_id", "action") == ACTIONS
        assert rows_of(R.read_parts(spark, f"{root}/h"), *BAR_COLUMNS) == wanted_rows(bars)
        if at.startswith("done"):
            assert at not in seen  # a finished part is left alone


def test_repair_proves_what_it_preserved(bars, spark, tmp_path):
    root = str(tmp_path)
    R.write_parts(history(bars), f"{root}/h", 5)

    def meddle(name):
        if name == "before":
            bars([bar("S1", "2025-01-01")]).select(*BAR_COLUMNS, R.part_of(5)).write.mode("append").partitionBy("part").parquet(f"{root}/h")

    with pytest.raises(ContractError, match="other_rows_changed"):
        run(spark, bars, root, meddle)


def test_nothing_to_repair(bars, spark, tmp_path):
    R.write_parts(history(bars), str(tmp_path / "h"), 5)
    report = R.repair_session(spark, str(tmp_path / "h"), bars([]), DAY, str(tmp_path / "log"), 5)
    assert report.collect() == []
    assert rows_of(R.read_parts(spark, str(tmp_path / "h")), *BAR_COLUMNS) == rows_of(history(bars), *BAR_COLUMNS)
