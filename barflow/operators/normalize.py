"""Raw provider rows -> typed bars, with per-security accept/reject verdicts.

A verdict is a column or a row, never an exception in a task: one bad security
must not stop the others. ``raise_*`` gates turn verdicts into errors at the end
of a job.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.functions.keep import keep_first, keep_last
from barflow.schemas import BAR_COLUMNS, BAR_VALUES, ContractError, require_columns

OHLC = ["open", "high", "low", "close"]


def utc_session(ts: Column | str) -> Column:
    """Session date as the UTC calendar date of the source timestamp."""
    return F.to_date(X.col(ts))


def exchange_session(ts: Column | str, zone: str = X.EXCHANGE_ZONE) -> Column:
    """Session date as the exchange-local calendar date of a UTC timestamp."""
    return F.to_date(F.from_utc_timestamp(X.col(ts), zone))


def typed_rows(raw: DataFrame, session: Callable[[Column], Column] = utc_session) -> DataFrame:
    """Coerce source columns; values that do not parse become NULL.

    A date is read as a timestamp (with its zone, if it names one) and
    ``session`` says which day that is: :func:`utc_session` or
    :func:`exchange_session`.

    ``adj_close`` falls back to ``close`` only where the source has no such
    column. A missing volume counts as zero.
    """
    require_columns(raw, ["date", "security_id", "ticker", *OHLC, "volume"], "provider rows")
    number = lambda c: F.col(c).try_cast("double")
    adj = number("adj_close") if "adj_close" in raw.columns else number("close")
    extra = [c for c in raw.columns if c not in BAR_COLUMNS]
    volume = number("volume")
    return raw.select(
        session(F.col("date").try_cast("timestamp")).alias("date"),
        "security_id",
        "ticker",
        *[number(c).alias(c) for c in OHLC],
        adj.alias("adj_close"),
        F.coalesce(F.nanvl(volume, F.lit(0.0)), F.lit(0.0)).try_cast("long").alias("volume"),
        *extra,
    )


def _complete() -> Column:
    ok = F.col("date").isNotNull()
    for c in OHLC:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return ok


def normalize_history(
    raw: DataFrame, order_col: str = "src_ord", session: Callable[[Column], Column] = utc_session
) -> DataFrame:
    """Bars of accepted securities plus ``verdict``; see :func:`accepted`.

    Rows lacking a date or one of O/H/L/C are dropped, a repeated date keeps its
    last source row, and a single unsound bar rejects the whole security. The
    verdict window runs after deduplication, so a partition of it holds at most
    one row per calendar date.
    """
    require_columns(raw, [order_col], "provider rows")
    rows = typed_rows(raw, session).filter(_complete())
    rows = keep_last(rows.select(*BAR_COLUMNS, order_col), ["security_id", "date"], [order_col])
    negative = F.least(*OHLC) < 0
    inverted = F.col("high") < F.col("low")
    per_security = Window.partitionBy("security_id")
    flag = lambda test: F.max(F.coalesce(test, F.lit(False))).over(per_security)
    verdict = (
        F.when(flag(negative), F.lit("negative_price"))
        .when(flag(inverted), F.lit("high_below_low"))
        .when(flag(~X.is_sound()), F.lit("qc_rejected"))
        .otherwise(F.lit("accepted"))
    )
    return rows.select(*BAR_COLUMNS, verdict.alias("verdict"))


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("verdict") == "accepted").select(*BAR_COLUMNS)


def normalize_existing(history: DataFrame, order_col: str) -> DataFrame:
    """Stored bars with valid dates, last row per date."""
    require_columns(history, [*BAR_COLUMNS, order_col], "history")
    rows = history.filter(F.col("date").isNotNull()).select(*BAR_COLUMNS, order_col)
    return keep_last(rows, ["security_id", "date"], [order_col]).select(*BAR_COLUMNS)


def normalize_index_bars(
    raw: DataFrame,
    provider: str,
    contract_version: str,
    order_col: str = "src_ord",
    segment_rows: int = 65536,
) -> DataFrame:
    """Index bars with provenance and an index-level ``verdict``.

    Volume is required here. An index is rejected for a negative volume, dates
    that are not strictly increasing in source order, or a broken envelope.
    """
    require_columns(raw, ["index_id", "source_symbol", "date", *OHLC, "volume", order_col], "index rows")
    number = lambda c: F.col(c).try_cast("double")
    rows = raw.select(
        "index_id",
        F.col("date").try_cast("date").alias("date"),
        *[number(c).alias(c) for c in [*OHLC, "volume"]],
        "source_symbol",
        order_col,
    )
    values = [*OHLC, "volume"]
    whole = F.lit(True)
    for c in values:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(c)
    rows = rows.filter(whole)
    envelope = (F.col("high") >= F.greatest("open", "low", "close")) & (
        F.col("low") <= F.least("open", "high", "close")
    )
    order = monotonic_check(rows, ["index_id"], "date", order_col, segment_rows)
    verdicts = (
        rows.groupBy("index_id")
        .agg(
            F.bool_or(F.col("volume") < 0).alias("bad_volume"),
            F.bool_or(~envelope).alias("bad_envelope"),
        )
        .join(order.select("index_id", "strictly_increasing"), "index_id")
        .select(
            "index_id",
            F.when(F.col("bad_volume"), "negative_volume")
            .when(~F.col("strictly_increasing"), "date_chronology")
            .when(F.col("bad_envelope"), "ohlc_envelope")
            .otherwise("accepted")
            .alias("verdict"),
        )
    )
    return rows.join(verdicts, "index_id").select(
        "index_id",
        "date",
        *values,
        F.lit(provider).alias("source_provider"),
        "source_symbol",
        F.lit(contract_version).alias("source_contract_version"),
        "verdict",
    )


def dedupe_keep(rows: DataFrame, keys: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """Keep the first or the last row per key under an explicit source order."""
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    return (keep_last if keep == "last" else keep_first)(rows, keys, order)


def split_incomplete(raw: DataFrame) -> DataFrame:
    """Label source rows ``valid`` or ``discarded`` (no date, or one of O/H/L/C missing)."""
    return typed_rows(raw).withColumn(
        "row_class", F.when(_complete(), F.lit("valid")).otherwise(F.lit("discarded"))
    )


def split_incomplete_checks(labelled: DataFrame) -> DataFrame:
    """Per security: row conservation and repeated valid dates."""
    valid = F.col("row_class") == "valid"
    per_date = labelled.groupBy("security_id", F.when(valid, F.col("date")).alias("date")).agg(
        F.count_if(valid).alias("valid"), F.count_if(~valid).alias("discarded")
    )
    return per_date.groupBy("security_id").agg(
        F.sum("valid").alias("valid_rows"),
        F.sum("discarded").alias("discarded_rows"),
        F.count_if(F.col("valid") > 1).alias("duplicate_valid_dates"),
    )


def finalized_filter(bars: DataFrame, cutoff: date | Column) -> DataFrame:
    """Bars on or before the finalization cutoff date."""
    return bars.filter(F.col("date") <= (F.lit(cutoff) if isinstance(cutoff, date) else cutoff))


def finalized_excluded(bars: DataFrame, cutoff: date | Column) -> DataFrame:
    """Histogram of the dates that :func:`finalized_filter` leaves out."""
    limit = F.lit(cutoff) if isinstance(cutoff, date) else cutoff
    return bars.filter(F.col("date") > limit).groupBy("date").agg(F.count("*").alias("excluded_rows"))


def select_session(rows: DataFrame, target: date, session: Column | str = "date") -> DataFrame:
    """One row per security with a candidate row on ``target``, and its class.

    ``VALID`` needs exactly one complete, sound row. ``INVALID`` is one row that
    is incomplete or fails the rules; ``NO_SINGLE_COMPLETE_ROW`` is more than one.
    """
    hits = rows.filter(X.col(session) == F.lit(target))
    packed = hits.groupBy("security_id").agg(
        F.count("*").alias("row_count"),
        F.min_by(F.struct("ticker", *BAR_VALUES), F.col("ticker")).alias("row"),
    )
    flat = packed.select("security_id", "row_count", "row.*")
    single = F.col("row_count") == 1
    issues = X.qc_issues()
    return flat.select(
        "security_id",
        F.lit(target).alias("date"),
        *[F.when(single, F.col(c)).alias(c) for c in ["ticker", *BAR_VALUES]],
        "row_count",
        F.when(~single, "NO_SINGLE_COMPLETE_ROW")
        .when(F.size(issues) == 0, "VALID")
        .otherwise("INVALID")
        .alias("session_class"),
        F.when(single, X.joined(issues)).alias("issues"),
    )


def session_availability(population: DataFrame, sessions: DataFrame) -> DataFrame:
    """Three-way label of a population: valid, partial (rows but none usable), missing."""
    return population.select("security_id").distinct().join(
        sessions.select("security_id", "session_class"), "security_id", "left"
    ).select(
        "security_id",
        F.when(F.col("session_class") == "VALID", "valid")
        .when(F.col("session_class").isNotNull(), "partial")
        .otherwise("missing")
        .alias("availability"),
    )


def batch_then_single(batch: DataFrame, single: DataFrame, order_col: str = "src_ord") -> DataFrame:
    """Batch rows where a security's batch is sound as a whole, else its single rows.

    Every security of either input appears once in ``source``: ``batch``,
    ``single`` or ``failed`` (no bar columns are kept for ``failed``).
    """
    b = normalize_history(batch, order_col).withColumn("source", F.lit("batch"))
    s = normalize_history(single, order_col).withColumn("source", F.lit("single"))
    good = F.col("verdict") == "accepted"
    per_security = Window.partitionBy("security_id")
    batch_ok = F.max(good & (F.col("source") == "batch")).over(per_security)
    single_ok = F.max(good & (F.col("source") == "single")).over(per_security)
    rows = b.unionByName(s).withColumn(
        "chosen", F.when(batch_ok, "batch").when(single_ok, "single").otherwise("failed")
    )
    return rows.filter(F.col("chosen") == F.col("source")).select(*BAR_COLUMNS, "source")


def batch_then_single_failed(batch: DataFrame, single: DataFrame, chosen: DataFrame) -> DataFrame:
    """Securities for which neither the batch nor the single rows were usable."""
    ids = batch.select("security_id").union(single.select("security_id")).distinct()
    return ids.join(chosen.select("security_id").distinct(), "security_id", "left_anti")


# Adjustment failures in the order they are reported.
ADJUST_ISSUES = (
    "invalid_adjustment_factor",
    "adjusted_nonfinite_or_nonpositive",
    "adjusted_high_violates_range",
    "adjusted_low_violates_range",
)


def adjusted_ohlc(bars: DataFrame) -> DataFrame:
    """O/H/L/C scaled by adj_close/close, the factor, and ``adjust_issue`` (NULL when sound)."""
    factor = X.safe_ratio("adj_close", "close")
    scaled = bars.withColumn("adjustment_factor", factor)
    for c in OHLC:
        scaled = scaled.withColumn(c, F.col(c) * F.col("adjustment_factor"))
    o, h, lo, c = (F.col(n) for n in OHLC)
    whole = X.is_finite(o) & X.is_finite(h) & X.is_finite(lo) & X.is_finite(c)
    issue = (
        F.when(
            ~X.is_finite("adjustment_factor") | (F.col("adjustment_factor") <= 0),
            ADJUST_ISSUES[0],
        )
        .when(~whole | (F.least(o, h, lo, c) <= 0), ADJUST_ISSUES[1])
        .when(h < F.greatest(o, lo, c), ADJUST_ISSUES[2])
        .when(lo > F.least(o, h, c), ADJUST_ISSUES[3])
    )
    return scaled.withColumn("adjust_issue", issue)


def qc_bad_bars(bars: DataFrame) -> DataFrame:
    """Bars that break at least one rule, with the rule names."""
    require_columns(bars, BAR_VALUES, "OHLCV QC")
    return bars.filter(~X.is_sound()).withColumn("issues", X.qc_issues())


def qc_gate(bars: DataFrame) -> DataFrame:
    """One row: bars seen, bars rejected."""
    require_columns(bars, BAR_VALUES, "OHLCV QC")
    return bars.agg(
        F.count("*").alias("bars"),
        F.count_if(~X.is_sound()).alias("rejected"),
    )


def raise_on_bad_bars(bars: DataFrame, samples: int = 5) -> DataFrame:
    """Return ``bars`` or raise with the count and the first samples by key."""
    rejected = qc_gate(bars).first()["rejected"]
    if rejected:
        rows = qc_bad_bars(bars).orderBy("security_id", "date").limit(samples)
        shown = [(r["security_id"], str(r["date"]), list(r["issues"])) for r in rows.collect()]
        raise ContractError(f"OHLCV QC rejected {rejected} bars; samples={shown}")
    return bars


def failure_rate_gate(results: DataFrame, threshold: float = 0.10) -> DataFrame:
    """One row: attempted, failed, rate and whether output may be written.

    ``results`` carries ``status``; ``skipped`` rows are not attempts. With no
    attempt at all the rate is NULL and nothing may be written.
    """
    tried = F.count_if(F.col("status") != "skipped")
    failed = F.count_if(F.col("status") == "failed")
    counts = results.agg(tried.alias("attempted"), failed.alias("failed"))
    rate = X.safe_ratio("failed", "attempted")
    return counts.select(
        "attempted",
        "failed",
        rate.alias("failure_rate"),
        F.coalesce(rate <= F.lit(threshold), F.lit(False)).alias("publish_allowed"),
    )


def monotonic_check(
    rows: DataFrame,
    keys: list[str],
    date_col: str = "date",
    order_col: str = "src_ord",
    segment_rows: int = 65536,
) -> DataFrame:
    """Per key: are dates strictly increasing in stored order?

    ``order_col`` is a row position. Neighbours are compared inside segments of
    positions, and only each segment's ends are compared across segments, so a
    key with any number of rows is spread over many tasks.
    """
    seg = (F.col(order_col) / F.lit(segment_rows)).cast("long")
    rows = rows.select(*keys, F.col(date_col).alias("d"), F.col(order_col).alias("o"), seg.alias("seg"))
    inside = Window.partitionBy(*keys, "seg").orderBy("o")
    ends = (
        rows.withColumn("prev", F.lag("d").over(inside))
        .groupBy(*keys, "seg")
        .agg(
            F.count("*").alias("n"),
            F.count_if((F.col("prev") >= F.col("d")) | F.col("d").isNull()).alias("inversions"),
            F.min_by("d", "o").alias("head"),
            F.max_by("d", "o").alias("tail"),
        )
    )
    across = Window.partitionBy(*keys).orderBy("seg")
    return (
        ends.withColumn("before", F.lag("tail").over(across))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("rows"),
            (F.sum("inversions") + F.count_if(F.col("before") >= F.col("head"))).alias("inversions"),
        )
        .withColumn("strictly_increasing", F.col("inversions") == 0)
    )


def nth_bar(bars: DataFrame, targets: DataFrame) -> DataFrame:
    """The bar at a 0-based position of each target's history, with checks.

    ``targets``: security_id, ticker, position, expected_rule. ``outcome`` is
    ``confirmed``, ``outside_history``, ``identity_differs`` or ``rule_not_found``.
    """
    wanted = targets.select(
        "security_id", F.col("ticker").alias("expected_ticker"), "position", "expected_rule"
    )
    order = Window.partitionBy("security_id").orderBy("date")
    numbered = (
        bars.join(wanted.select("security_id"), "security_id", "left_semi")
        .withColumn("position", F.row_number().over(order) - 1)
        .withColumn("issues", X.qc_issues())
    )
    hit = wanted.join(numbered, ["security_id", "position"], "left")
    return hit.select(
        "security_id",
        "position",
        "expected_rule",
        "date",
        "ticker",
        *BAR_VALUES,
        X.joined(F.col("issues")).alias("issues"),
        F.when(F.col("date").isNull(), "outside_history")
        .when(~F.col("ticker").eqNullSafe(F.col("expected_ticker")), "identity_differs")
        .when(~F.array_contains("issues", F.col("expected_rule")), "rule_not_found")
        .otherwise("confirmed")
        .alias("outcome"),
    )


# Names of the source checks of an index.
INDEX_CHECKS = (
    "dates_parseable",
    "dates_unique",
    "dates_monotonic",
    "recent_ohlc_complete",
    "recent_ohlc_valid",
    "recent_volume_complete",
    "recent_volume_nonnegative",
    "recent_volume_not_all_zero",
    "recent_volume_varies",
)


def index_source_checks(rows: DataFrame, recent: int = 60, requested: DataFrame | None = None) -> DataFrame:
    """Per index: source checks over all rows and over the most recent ones.

    Dates are compared after sorting, so they are monotonic exactly when every
    date parses. An index of ``requested`` (index_id) without any row is listed
    with ``nonempty`` false, no facts and status FAIL.
    """
    require_columns(rows, ["index_id", "date", *OHLC, "volume"], "index source")
    typed = rows.select(
        "index_id",
        F.col("date").try_cast("date").alias("date"),
        *[F.col(c).try_cast("double").alias(c) for c in [*OHLC, "volume"]],
    )
    per_date = typed.groupBy("index_id", "date").agg(F.count("*").alias("n"))
    overall = per_date.groupBy("index_id").agg(
        F.sum("n").alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        (F.count_if(F.col("date").isNull()) == 0).alias("dates_parseable"),
        (F.count_if(F.col("n") > 1) == 0).alias("dates_unique"),
        (F.count_if(F.col("date").isNull()) == 0).alias("dates_monotonic"),
    )
    # NULL dates sort to the end of the source, so they count as most recent.
    latest = Window.partitionBy("index_id").orderBy(
        F.col("date").desc_nulls_first(), *[F.col(c).desc() for c in [*OHLC, "volume"]]
    )
    tail = typed.withColumn("rn", F.row_number().over(latest)).filter(F.col("rn") <= recent)
    complete = F.lit(True)
    for c in OHLC:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(c)
    has_volume = F.col("volume").isNotNull() & ~F.isnan("volume")
    sound = complete & (
        (F.col("high") >= F.greatest("open", "close", "low"))
        & (F.col("low") <= F.least("open", "close", "high"))
        & (F.least(*OHLC) > 0)
    )
    window = tail.groupBy("index_id").agg(
        F.count("*").alias("sample_rows"),
        F.bool_and(complete).alias("recent_ohlc_complete"),
        F.bool_and(F.coalesce(sound, F.lit(False))).alias("recent_ohlc_valid"),
        F.bool_and(has_volume).alias("recent_volume_complete"),
        F.bool_and(F.when(has_volume, F.col("volume") >= 0).otherwise(F.lit(True))).alias(
            "recent_volume_nonnegative"
        ),
        F.bool_or(F.coalesce(has_volume & (F.col("volume") > 0), F.lit(False))).alias(
            "recent_volume_not_all_zero"
        ),
        (F.count_distinct(F.when(has_volume, F.col("volume"))) >= 2).alias("recent_volume_varies"),
        F.min(F.when(has_volume, F.col("volume"))).alias("volume_recent_min"),
        F.max(F.when(has_volume, F.col("volume"))).alias("volume_recent_max"),
        F.count_distinct(F.when(has_volume, F.col("volume"))).alias("volume_recent_unique"),
    )
    joined = overall.join(window, "index_id")
    passed = F.lit(True)
    for name in INDEX_CHECKS:
        passed = passed & F.col(name)
    if requested is not None:
        joined = requested.select("index_id").distinct().join(joined, "index_id", "full_outer")
    nonempty = F.col("rows").isNotNull()
    return joined.withColumns({"nonempty": nonempty, "status": F.when(nonempty & passed, "PASS").otherwise("FAIL")})


