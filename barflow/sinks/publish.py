"""Immutable snapshots behind a pointer that is written last."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.continuity import terminal_summary
from barflow.operators.ema import ema_state_checks
from barflow.operators.snapshots import set_reduction_diff, window_advance_diff
from barflow.schemas import BAR_COLUMNS, EMA_PERIODS, EMA_STATE_COLUMNS, ContractError
from barflow.session import folder_names, path_exists

SCHEMA_VERSION = 2
_CHUNKS = 4
_CHUNK_DIGITS = 15

POINTER = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("as_of_date", T.StringType()),
        T.StructField("terminal_date_max", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("securities", T.LongType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("previous_path", T.StringType()),
        T.StructField("source_fingerprint", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("evidence", T.StringType()),
    ]
)
# What an EMA state must say of itself before it may be loaded.
EMA_EVIDENCE = {"price_basis": "adj_close", "periods": list(EMA_PERIODS), "policy": "recursive_then_verified"}


@dataclass(frozen=True)
class Pointer:
    seq: int
    schema_version: int
    as_of_date: str
    terminal_date_max: str
    path: str
    rows: int
    securities: int
    fingerprint: str
    previous_path: str | None
    source_fingerprint: str | None
    created_at: str
    evidence: str | None = None


def _row_hash(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def fingerprint_aggregates(columns: list[str]) -> list[Column]:
    """Count and sums of slices of each row's SHA-256.

    Sums merge in any order, so reordering or repartitioning changes nothing
    while a changed, lost or repeated row does; no rows are gathered anywhere. A
    slice of 60 bits is summed as three long numbers of 20 bits, which no count of
    rows below 2^43 overflows; decimals are made of the sums only.
    """
    h = _row_hash(columns)
    parts = []
    for i in range(_CHUNKS):
        digits = F.substring(h, 1 + i * _CHUNK_DIGITS, _CHUNK_DIGITS)
        number = F.conv(digits, 16, 10).cast("long")
        whole = F.lit(0).cast("decimal(20,0)")
        for shift in (40, 20, 0):
            piece = F.sum(F.shiftright(number, shift).bitwiseAND(F.lit((1 << 20) - 1).cast("long")))
            whole = whole + piece.cast("decimal(20,0)") * F.lit(1 << shift).cast("decimal(14,0)")
        parts.append(whole.cast("decimal(38,0)").alias(f"h{i}"))
    return [F.count(F.lit(1)).alias("rows"), *parts]


def _digest(values: dict) -> str:
    import hashlib

    text = "|".join(str(values.get(k) or 0) for k in ["rows", *[f"h{i}" for i in range(_CHUNKS)]])
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(df: DataFrame, columns: list[str]) -> tuple[int, str]:
    """(rows, order-insensitive content fingerprint) of ``columns``."""
    row = df.agg(*fingerprint_aggregates(columns)).first().asDict()
    return row["rows"], _digest(row)


def fingerprint_frame(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same fingerprint as a one-row frame, for use inside a plan."""
    parts = df.agg(*fingerprint_aggregates(columns))
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in parts.columns])
    return parts.select("rows", F.sha2(text, 256).alias("fingerprint"))


def read_pointer(spark: SparkSession, root: str) -> Pointer | None:
    """The newest pointer below ``root``, or None before the first publication."""
    if not folder_names(spark, f"{root}/pointer"):
        return None
    rows = spark.read.schema(POINTER).json(f"{root}/pointer/*")
    newest = rows.orderBy(F.col("seq").desc()).first()
    return None if newest is None else Pointer(**newest.asDict())


def decide(current: Pointer | None, as_of: date, candidate_fingerprint: str | None) -> str:
    """CREATE or REUSE; raises on a rollback, a same-day change or a malformed pointer."""
    if current is None:
        return "CREATE"
    if not (current.as_of_date and current.fingerprint and current.path):
        raise ContractError("current pointer lacks lineage fields")
    published = date.fromisoformat(current.as_of_date)
    if as_of < published:
        raise ContractError(f"rollback rejected: candidate {as_of} is older than {published}")
    if as_of > published:
        return "CREATE"
    if candidate_fingerprint == current.fingerprint:
        return "REUSE"
    raise ContractError(f"same-day mutation rejected for {as_of}")


@dataclass(frozen=True)
class Publication:
    decision: str
    pointer: Pointer


def publish_snapshot(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    as_of: date,
    columns: list[str] | None = None,
    date_col: str = "date",
    source_fingerprint: str | None = None,
    recovery: bool = False,
    evidence: dict | None = None,
) -> Publication:
    """Write an immutable run, verify it by reading it back, then move the pointer.

    The fingerprint is observed while the run is written. A same-day candidate is
    only fingerprinted: it is reused when equal and refused when not, except with
    ``recovery`` (the published one is quarantined), which writes a new run named
    by content. A whole run folder left by a failed attempt is adopted when it
    matches and refused when not; beside an unfinished one the run gets a name of its own.
    """
    columns = columns or BAR_COLUMNS
    current = read_pointer(spark, root)
    same_day = current is not None and current.as_of_date == as_of.isoformat()
    path = f"{root}/runs/{as_of.isoformat()}"
    if current is not None and not (same_day and recovery):
        known = fingerprint(df, columns)[1] if same_day else None
        if decide(current, as_of, known) == "REUSE":
            return Publication("REUSE", current)
    elif same_day:
        path = f"{path}-recovery-{fingerprint(df, columns)[1][:16]}"
    expected = None
    if path_exists(spark, path):
        expected = fingerprint(df, columns)[1]
        if not path_exists(spark, f"{path}/_SUCCESS"):
            # an attempt that stopped while it wrote stays as it is; this run gets a name of its own
            path, expected = f"{path}-{uuid.uuid4().hex[:16]}", None
    if expected is None:
        seen = Observation()
        rows = df.select(*columns)
        rows.observe(seen, *fingerprint_aggregates(columns)).write.mode("errorifexists").option(
            "compression", "zstd"
        ).parquet(path)
        expected = _digest(seen.get)
    written = spark.read.parquet(path)
    last = F.max(date_col).cast("string").alias("last")
    facts = written.agg(*fingerprint_aggregates(columns), last).first().asDict()
    actual = _digest(facts)
    if actual != expected:
        raise ContractError(f"run {path} does not hold the candidate; pointer unchanged")
    pointer = Pointer(
        seq=(current.seq + 1) if current else 1,
        schema_version=SCHEMA_VERSION,
        as_of_date=as_of.isoformat(),
        terminal_date_max=facts["last"],
        path=path,
        rows=facts["rows"],
        securities=written.select("security_id").distinct().count(),
        fingerprint=actual,
        previous_path=current.path if current else None,
        source_fingerprint=source_fingerprint,
        created_at=datetime.now(UTC).isoformat(),
        evidence=None if evidence is None else json.dumps(evidence, sort_keys=True),
    )
    _write_pointer(spark, root, pointer)
    return Publication("CREATE", pointer)


def _write_pointer(spark: SparkSession, root: str, pointer: Pointer) -> None:
    row = spark.createDataFrame([tuple(asdict(pointer).values())], POINTER)
    row.write.mode("errorifexists").json(f"{root}/pointer/{pointer.seq:010d}")


def load_snapshot(spark: SparkSession, root: str, columns: list[str] | None = None) -> tuple[DataFrame, Pointer]:
    """The published data and its pointer, after checking version, content and counts."""
    columns = columns or BAR_COLUMNS
    pointer = read_pointer(spark, root)
    if pointer is None:
        raise FileNotFoundError(f"{root} has no published snapshot")
    if pointer.schema_version not in (1, 2):
        raise ContractError("unknown snapshot schema version")
    if pointer.schema_version == 2 and pointer.terminal_date_max != pointer.as_of_date:
        raise ContractError("as-of date and last terminal date differ")
    data = spark.read.parquet(pointer.path)
    count, actual = fingerprint(data, columns)
    if actual != pointer.fingerprint or count != pointer.rows:
        raise ContractError("snapshot content does not match its pointer")
    ids = data.select("security_id").distinct().count()
    if ids != pointer.securities:
        raise ContractError("snapshot securities do not match its pointer")
    return data, pointer


def publish_ready(
    spark: SparkSession, candidate: DataFrame, root: str, quarantined: bool = False
) -> Publication:
    """Publish a READY candidate, or keep the canonical one for a harmless same-day change.

    A candidate that only moves some fixed windows forward, or only drops whole
    securities, is deferred to the next date (``DEFERRED``). The terminal dates
    must be coherent.
    """
    summary = terminal_summary(candidate).first()
    if summary["verdict"] != "coherent":
        raise ContractError(f"terminal dates rejected: {summary['verdict']}")
    as_of = summary["as_of_date"]
    current = read_pointer(spark, root)
    if current is not None and current.as_of_date == as_of.isoformat() and not quarantined:
        if fingerprint(candidate, BAR_COLUMNS)[1] != current.fingerprint:
            canonical = spark.read.parquet(current.path)
            for verdict in (
                window_advance_diff(canonical, candidate, as_of),
                set_reduction_diff(canonical, candidate),
            ):
                if verdict.first()["safe"]:
                    return Publication("DEFERRED", current)
    return publish_snapshot(spark, candidate, root, as_of, recovery=quarantined)


def promote_ema(
    spark: SparkSession,
    state: DataFrame,
    equivalence_report: DataFrame,
    root: str,
    as_of: date,
    source_fingerprint: str,
) -> Publication:
    """Publish EMA state only after its checks and its equivalence report passed."""
    if not ema_state_checks(state).first()["valid"]:
        raise ContractError("EMA state is empty or unsound")
    report = equivalence_report.first().asDict()
    if not report["passed"]:
        raise ContractError("EMA equivalence did not pass; pointer unchanged")
    evidence = {**EMA_EVIDENCE, "equivalence": report}
    return publish_snapshot(
        spark, state, root, as_of, EMA_STATE_COLUMNS, "as_of_date", source_fingerprint, evidence=evidence
    )


def ema_evidence_issues(pointer: Pointer) -> list[str]:
    """What is missing or failing in the promotion evidence of an EMA state."""
    held = json.loads(pointer.evidence or "{}")
    issues = [name for name, value in EMA_EVIDENCE.items() if held.get(name) != value]
    report = held.get("equivalence") or {}
    if not report.get("verified", 0) > 0:
        issues.append("verified")
    issues += [n for n in ("numeric_failures", "classification_mismatches") if report.get(n) != 0]
    if report.get("passed") is not True:
        issues.append("passed")
    if not pointer.source_fingerprint:
        issues.append("source_fingerprint")
    return issues


def load_ema_state(spark: SparkSession, root: str, source_fingerprint: str | None = None) -> DataFrame:
    """Published EMA state with sound promotion evidence; optionally only if built from the named source."""
    state, pointer = load_snapshot(spark, root, EMA_STATE_COLUMNS)
    if issues := ema_evidence_issues(pointer):
        raise ContractError(f"EMA promotion evidence missing or failing: {', '.join(issues)}")
    if source_fingerprint is not None and pointer.source_fingerprint != source_fingerprint:
        raise ContractError("EMA state was built from another source")
    if not ema_state_checks(state).first()["valid"]:
        raise ContractError("EMA state is empty or unsound")
    return state
