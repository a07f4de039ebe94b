"""Recursive moving-average state: bootstrap, advance, update, equivalence."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.functions.folds import ema_fold
from barflow.schemas import EMA_FIELDS, EMA_PERIODS, EMA_STATE, EMA_STATE_COLUMNS, require_columns
from barflow.session import materialize

MIN_BOOTSTRAP_BARS = max(EMA_PERIODS)
PRICE = "adj_close"
SOURCE_COLUMNS = ["date", "security_id", "ticker", PRICE]

# Tolerance for a persisted price against its source.
PRICE_TOLERANCE = 1e-10


def _per_date(bars: DataFrame, unique_keys: bool) -> DataFrame:
    """One row per (security, date) with the number of source rows as ``n``.

    Grouping first keeps the arrays built later as short as the calendar, no
    matter how often a row is repeated. ``unique_keys`` skips it for inputs whose
    keys are unique by construction.
    """
    require_columns(bars, SOURCE_COLUMNS, "EMA source")
    if unique_keys:
        return bars.select("security_id", "date", "ticker", F.col(PRICE).alias("px"), F.lit(1).alias("n"))
    return bars.groupBy("security_id", "date").agg(
        F.max("ticker").alias("ticker"),
        # max would hide a NULL beside a number, so a NULL makes the group NULL
        F.when(F.bool_or(F.col(PRICE).isNull()), None).otherwise(F.max(PRICE)).alias("px"),
        F.count("*").alias("n"),
    )


def _bad_price() -> Column:
    return ~X.is_finite("px") | F.coalesce(F.col("px") <= 0, F.lit(True))


def _packed(bars: DataFrame, unique_keys: bool) -> DataFrame:
    """One row per security: its (date, px) series in date order, latest ticker, and flaws."""
    return _per_date(bars, unique_keys).groupBy("security_id").agg(
        F.max_by("ticker", "date").alias("ticker"),
        F.sort_array(F.collect_list(F.struct("date", "px"))).alias("series"),
        F.bool_or(F.col("n") > 1).alias("dup"),
        F.bool_or(F.col("date").isNull()).alias("no_date"),
        F.bool_or(_bad_price()).alias("bad_price"),
    )


def ema_bootstrap(bars: DataFrame, unique_keys: bool = False) -> DataFrame:
    """State of every security from its full history, with ``outcome``.

    ``outcome`` is ``ok``, ``null_date``, ``duplicate_dates``, ``invalid_price``
    or ``too_few_bars``; state columns are NULL unless it is ``ok``.
    """
    packed = _packed(bars, unique_keys)
    outcome = (
        F.when(F.col("no_date"), "null_date")
        .when(F.col("bad_price"), "invalid_price")
        .when(F.col("dup"), "duplicate_dates")
        .when(F.size("series") < MIN_BOOTSTRAP_BARS, "too_few_bars")
        .otherwise("ok")
    )
    folded = packed.withColumn("outcome", outcome).select(
        "security_id",
        "ticker",
        "outcome",
        F.try_element_at("series", F.lit(-1)).alias("last"),
        F.when(F.col("outcome") == "ok", ema_fold(F.col("series").getField("px"))).alias("ema"),
    )
    ok = F.col("outcome") == "ok"
    return folded.select(
        "security_id",
        "ticker",
        F.when(ok, F.col("last.date")).alias("as_of_date"),
        F.when(ok, F.col("last.px")).alias("last_price"),
        *[F.col(f"ema.{f}").alias(f) for f in EMA_FIELDS],
        "outcome",
    )


def bootstrapped(bars: DataFrame, unique_keys: bool = False) -> DataFrame:
    """State rows of the securities that bootstrap cleanly."""
    return ema_bootstrap(bars, unique_keys).filter(F.col("outcome") == "ok").select(*EMA_STATE_COLUMNS)


def extended_bootstrap(base: DataFrame, added: DataFrame) -> DataFrame:
    """``ema_bootstrap`` of a history and later bars, from the history's own bootstrap ``base``, carried on term by term.

    ``base`` has the securities with outcome ``ok``; ``added`` one row (security_id,
    date, ticker, adj_close, n) per key, all dates later than the base's.
    """
    flaws = added.select("security_id", F.col(PRICE).alias("px"), "n").groupBy("security_id").agg(
        F.bool_or(_bad_price()).alias("bad_price"), F.bool_or(F.col("n") > 1).alias("dup")
    )
    anchors = base.select(F.col("as_of_date").alias("date"), "security_id", "ticker", F.col("last_price").alias(PRICE))
    rows = added.select(*SOURCE_COLUMNS).unionByName(anchors)
    moved = ema_advance(base.select(*EMA_STATE_COLUMNS), rows, True).join(flaws, "security_id")
    outcome = F.when(F.col("bad_price"), "invalid_price").when(F.col("dup"), "duplicate_dates").otherwise("ok")
    ok = outcome == "ok"
    ticker = F.when(ok, F.col("ticker")).alias("ticker")
    return moved.select("security_id", ticker, *[F.when(ok, F.col(c)).alias(c) for c in EMA_STATE_COLUMNS if c not in ("security_id", "ticker")], outcome.alias("outcome"))


def _prior(state: DataFrame) -> DataFrame:
    require_columns(state, EMA_STATE_COLUMNS, "EMA state")
    return state.select(
        "security_id",
        F.col("as_of_date").alias("p_date"),
        F.col("last_price").alias("p_price"),
        *[F.col(f).alias(f"p_{f}") for f in EMA_FIELDS],
        F.lit(True).alias("has_state"),
    )


def _carry(joined: DataFrame) -> DataFrame:
    """Advance expressions over rows that pair a packed security with its prior state."""
    newer = F.filter("series", lambda s: s.getField("date") >= F.col("p_date"))
    j = joined.withColumn("since", newer)
    head = F.try_element_at("since", F.lit(1))
    on_date = head.getField("date").eqNullSafe(F.col("p_date"))
    price_ok = X.is_close("p_price", head.getField("px"), PRICE_TOLERANCE, PRICE_TOLERANCE)
    state_ok = F.lit(True)
    for f in EMA_FIELDS:
        state_ok = state_ok & X.is_finite(f"p_{f}") & F.coalesce(F.col(f"p_{f}") > 0, F.lit(False))
    flawed = F.coalesce(F.col("dup") | F.col("no_date") | F.col("bad_price"), F.lit(False))
    reason = (
        F.when(flawed, "invalid_source")
        .when(~on_date, "state_date_outside_window")
        .when(~price_ok, "last_price_disagrees")
        .when(~state_ok, "invalid_state")
    )
    j = j.withColumn("reason", F.when(F.col("has_state"), reason))
    fine = F.col("has_state") & F.col("reason").isNull()
    prices = F.col("since").getField("px")
    seed = F.struct(*[F.col(f"p_{f}").alias(f) for f in EMA_FIELDS])
    rest = F.slice(prices, 2, F.greatest(F.size(prices) - 1, F.lit(0)))
    j = j.withColumn("ema", F.when(fine, ema_fold(rest, seed)))
    last = F.try_element_at("since", F.lit(-1))
    return j.select(
        "security_id",
        F.when(fine, F.col("ticker")).alias("ticker"),
        F.when(fine, last.getField("date")).alias("as_of_date"),
        F.when(fine, last.getField("px")).alias("last_price"),
        *[F.col(f"ema.{f}").alias(f) for f in EMA_FIELDS],
        F.when(fine, F.size("since") - 1).alias("advanced_bars"),
        F.when(F.col("has_state"), ~fine).alias("needs_rebuild"),
        "reason",
        F.try_element_at("series", F.lit(-1)).getField("date").alias("ready_date"),
        F.try_element_at("series", F.lit(-1)).getField("px").alias("ready_price"),
    )


def ema_advance(state: DataFrame, rows: DataFrame, unique_keys: bool = False) -> DataFrame:
    """State carried over the bars newer than its own date.

    Bars and state meet as one row per security. ``needs_rebuild`` is true when
    the state date has no bar, its price differs from the stored one, the stored
    numbers are not positive and finite, or the bars are flawed; ``reason`` says
    which.
    """
    pairs = _prior(state).join(_packed(rows, unique_keys), "security_id", "left")
    return _carry(pairs).drop("ready_date", "ready_price")


def ema_update(
    ready: DataFrame,
    history: DataFrame,
    state: DataFrame | None,
    rebuild_hints: DataFrame | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """New state of every READY security with the ``route`` that produced it.

    ``bootstrap`` for new securities, ``rebuild`` for hinted ones and for those
    whose state cannot be carried on, else ``recursive`` or ``unchanged``. Full
    history is read only for bootstrap and rebuild, cut at the security's last
    READY date and checked against its last READY price; a failed check is named
    in ``error`` and leaves the state columns NULL.

    The routed securities, one row each, are written to the shared folder, so the
    READY rows are read once although two branches follow.
    """
    packed = _packed(ready, unique_keys)
    if state is None:
        state = packed.sparkSession.createDataFrame([], EMA_STATE)
    pairs = packed.join(_prior(state), "security_id", "left")
    routed = _carry(pairs)
    if rebuild_hints is None:
        routed = routed.withColumn("hinted", F.lit(False))
    else:
        hints = rebuild_hints.select("security_id").distinct().withColumn("hinted", F.lit(True))
        routed = routed.join(hints, "security_id", "left")
    route = (
        F.when(F.col("needs_rebuild").isNull(), "bootstrap")
        .when(F.coalesce("hinted", F.lit(False)) | F.col("needs_rebuild"), "rebuild")
        .when(F.col("advanced_bars") > 0, "recursive")
        .otherwise("unchanged")
    )
    routed = materialize(routed.withColumn("route", route), "ema-routes")
    carried = routed.filter(F.col("route").isin("recursive", "unchanged")).select(
        *EMA_STATE_COLUMNS, "route", F.lit(None).cast("string").alias("error")
    )
    full = routed.filter(F.col("route").isin("bootstrap", "rebuild")).select(
        "security_id", "ready_date", "ready_price", "route"
    )
    source = (
        history.select(*SOURCE_COLUMNS)
        .join(full.select("security_id", "ready_date"), "security_id")
        .filter(F.col("date") <= F.col("ready_date"))
        .select(*SOURCE_COLUMNS)
    )
    built = full.join(ema_bootstrap(source, unique_keys), "security_id", "left")
    error = (
        F.when(F.col("outcome").isNull(), "no_history_through_ready_date")
        .when(F.col("outcome") != "ok", F.col("outcome"))
        .when(F.col("as_of_date") != F.col("ready_date"), "ready_date_mismatch")
        .when(
            ~X.is_close("last_price", "ready_price", PRICE_TOLERANCE, PRICE_TOLERANCE),
            "ready_price_mismatch",
        )
    )
    built = built.withColumn("error", error)
    good = F.col("error").isNull()
    rebuilt = built.select(
        "security_id",
        *[F.when(good, F.col(c)).alias(c) for c in EMA_STATE_COLUMNS[1:]],
        "route",
        "error",
    )
    return carried.unionByName(rebuilt)


def ema_state_checks(state: DataFrame) -> DataFrame:
    """One row: rows, repeated ids, NULL identifiers or dates, unusable numbers, verdict."""
    require_columns(state, EMA_STATE_COLUMNS, "EMA state")
    bad_number = F.lit(False)
    for f in ["last_price", *EMA_FIELDS]:
        bad_number = bad_number | ~X.is_finite(f) | F.coalesce(F.col(f) <= 0, F.lit(True))
    per_id = state.groupBy("security_id").agg(
        F.count("*").alias("n"),
        F.count_if(
            F.col("security_id").isNull() | F.col("ticker").isNull() | F.col("as_of_date").isNull()
        ).alias("nulls"),
        F.count_if(bad_number).alias("bad"),
    )
    zero = F.lit(0)
    out = per_id.agg(
        F.coalesce(F.sum("n"), zero).alias("state_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_ids"),
        F.coalesce(F.sum("nulls"), zero).alias("null_rows"),
        F.coalesce(F.sum("bad"), zero).alias("bad_number_rows"),
    )
    sound = (
        (F.col("state_rows") > 0)
        & (F.col("repeated_ids") == 0)
        & (F.col("null_rows") == 0)
        & (F.col("bad_number_rows") == 0)
    )
    return out.withColumn("valid", sound)


def required_plus_sample(state: DataFrame, required: DataFrame, sample_size: int) -> DataFrame:
    """All required ids plus the first ``sample_size`` others by id, with the mode label.

    ``selection`` is ``required``, ``sample`` or ``unknown_required`` for an id the
    state does not hold, which a caller must treat as an error.
    """
    ids = state.select("security_id").distinct()
    req = required.select("security_id").distinct()
    known = req.join(ids, "security_id", "left_semi")
    unknown = req.join(ids, "security_id", "left_anti")
    rest = ids.join(req, "security_id", "left_anti").orderBy("security_id").limit(sample_size)
    n_ids = ids.agg(F.count("*")).scalar()
    n_known = known.agg(F.count("*")).scalar()
    mode = (
        F.when(n_known == n_ids, "all_required")
        .when(n_known > 0, "required_plus_sample")
        .otherwise("sample")
    )
    return (
        known.withColumn("selection", F.lit("required"))
        .unionByName(rest.withColumn("selection", F.lit("sample")))
        .unionByName(unknown.withColumn("selection", F.lit("unknown_required")))
        .withColumn("mode", mode)
    )


def ema_equivalence(
    candidate: DataFrame,
    history: DataFrame,
    selected: DataFrame,
    cutoff: date,
    rtol: float = 1e-8,
    atol: float = 1e-8,
    unique_keys: bool = False,
) -> DataFrame:
    """Per selected security: persisted state against a recomputation up to ``cutoff``.

    The tolerance scales with the recomputed value. Securities whose as-of dates
    differ are a numeric failure and their fields are not compared.
    """
    ids = selected.select("security_id").distinct()
    cut = history.filter(F.col("date") <= F.lit(cutoff)).join(ids, "security_id", "left_semi")
    ref = ema_bootstrap(cut, unique_keys)
    fields = ["last_price", *EMA_FIELDS]
    ref = ref.select(
        "security_id",
        "outcome",
        F.col("as_of_date").alias("ref_as_of_date"),
        *[F.col(f).alias(f"ref_{f}") for f in fields],
    )
    j = ids.join(candidate.select(*EMA_STATE_COLUMNS), "security_id", "left").join(ref, "security_id", "left")
    dated = F.col("as_of_date").eqNullSafe(F.col("ref_as_of_date")) & (F.col("outcome") == "ok")
    dated = F.coalesce(dated, F.lit(False))
    diffs = [F.abs(F.col(f) - F.col(f"ref_{f}")) for f in fields]
    rels = [
        F.when(F.col(f"ref_{f}") != 0, d / F.abs(F.col(f"ref_{f}"))).otherwise(d)
        for f, d in zip(fields, diffs)
    ]
    off = [F.when(~X.is_close(f, f"ref_{f}", rtol, atol), F.lit(f)) for f in fields]
    failures = F.when(~dated, F.array(F.lit("as_of_date"))).otherwise(F.array_compact(F.array(*off)))
    return j.select(
        "security_id",
        F.when(dated, F.greatest(*diffs)).alias("max_abs_error"),
        F.when(dated, F.greatest(*rels)).alias("max_relative_error"),
        X.joined(failures).alias("failed_fields"),
        F.size(failures).alias("numeric_failures"),
        (
            dated
            & (X.trend_class() != X.trend_class("ref_last_price", [f"ref_{f}" for f in EMA_FIELDS]))
        ).alias("class_mismatch"),
    )


def ema_equivalence_report(per_security: DataFrame) -> DataFrame:
    """One row: verified, worst errors, failures, mismatches, verdict."""
    out = per_security.agg(
        F.count("*").alias("verified"),
        F.coalesce(F.max("max_abs_error"), F.lit(0.0)).alias("max_abs_error"),
        F.coalesce(F.max("max_relative_error"), F.lit(0.0)).alias("max_relative_error"),
        F.coalesce(F.sum("numeric_failures"), F.lit(0)).alias("numeric_failures"),
        F.count_if("class_mismatch").alias("classification_mismatches"),
    )
    passed = (
        (F.col("verified") > 0)
        & (F.col("numeric_failures") == 0)
        & (F.col("classification_mismatches") == 0)
    )
    return out.withColumn("passed", passed)


def rebuild_hints(per_security: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Ids that failed equivalence, united with hints not yet consumed."""
    failed = per_security.filter((F.col("numeric_failures") > 0) | F.col("class_mismatch")).select(
        "security_id"
    )
    return failed.distinct() if existing is None else failed.union(existing.select("security_id")).distinct()
