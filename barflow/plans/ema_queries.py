"""Queries over moving-average state, signals and corporate actions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.operators import corporate as K
from barflow.operators import ema as E
from barflow.operators import signals as G
from barflow.operators import windows as W
from barflow.plans import fixtures as fx
from barflow.plans.catalog import query
from barflow.plans.fixtures import with_ctes
from barflow.schemas import EMA_PERIODS, EMA_STATE_COLUMNS

STATE = ", ".join(EMA_STATE_COLUMNS)

# keys of the derived bars are unique by their grouping
UNIQUE = True


def _fold(prices: str, seed: str | None = None) -> list[str]:
    """SQL folds of a price list; with a seed column prefix the fold starts from it."""
    out = []
    for p in EMA_PERIODS:
        alpha = f"(CAST(2 AS DOUBLE) / {p + 1})"
        start = f"list_prepend({seed}ema{p}, {prices})" if seed else prices
        out.append(
            f"list_reduce({start}, lambda acc, x: {alpha} * x + (CAST(1 AS DOUBLE) - {alpha}) * acc) AS ema{p}"
        )
    return out


def bootstrap_sql(source: str) -> str:
    return (
        f"SELECT security_id, ticker, as_of_date, last_price, {', '.join(_fold('px'))} FROM"
        " (SELECT security_id, arg_max(ticker, date) AS ticker, max(date) AS as_of_date, arg_max(adj_close, date) AS last_price,"
        f" list(adj_close ORDER BY date) AS px FROM {source} GROUP BY 1 HAVING count(*) >= 200)"
    )


TREND = (
    "CASE WHEN last_price > ema20 AND ema20 > ema50 AND ema50 > ema150 AND ema150 > ema200 THEN 'STACKED_UP'"
    " WHEN last_price < ema20 AND ema20 < ema50 AND ema50 < ema150 AND ema150 < ema200 THEN 'STACKED_DOWN'"
    " ELSE 'MIXED' END"
)


def all_state(spark, folder):
    return E.bootstrapped(fx.bars(spark, folder), UNIQUE)


@query("ema_bootstrap", with_ctes("bars", bootstrap_sql("bars")))
def ema_bootstrap(spark, folder):
    return all_state(spark, folder)


@query(
    "ema_bootstrap_outcome",
    with_ctes(
        "dirty_bars",
        """SELECT security_id, CASE WHEN bool_or(adj_close IS NULL OR isnan(adj_close) OR isinf(adj_close) OR adj_close <= 0) THEN 'invalid_price'
 WHEN count(*) < 200 THEN 'too_few_bars' ELSE 'ok' END AS outcome FROM dirty_bars GROUP BY 1""",
    ),
)
def ema_bootstrap_outcome(spark, folder):
    return E.ema_bootstrap(fx.dirty_bars(spark, folder)).select("security_id", "outcome")


@query(
    "trend_class",
    with_ctes(
        "bars eligible_members",
        f"SELECT trend, count(*) AS securities FROM (SELECT {TREND} AS trend FROM state WHERE security_id IN"
        " (SELECT security_id FROM eligible_members)) GROUP BY 1",
        state=bootstrap_sql("bars"),
    ),
)
def trend_class(spark, folder):
    members = fx.eligible_members(spark, folder).select("security_id")
    held = fx.bars(spark, folder).join(members, "security_id", "left_semi")
    state = E.bootstrapped(held, UNIQUE)
    return state.groupBy(X.trend_class().alias("trend")).agg(F.count("*").alias("securities"))


STATE_DAY = date(2001, 6, 30)


def _old_state(spark, folder, bars=None):
    bars = fx.bars(spark, folder) if bars is None else bars
    return E.bootstrapped(bars.filter(F.col("date") <= STATE_DAY), UNIQUE)


_OLD = bootstrap_sql(f"(SELECT * FROM bars WHERE date <= DATE '{STATE_DAY}')")
_TAIL = "SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 300"


def _ready(spark, folder):
    return W.rolling_tail(fx.bars(spark, folder))


@query(
    "ema_advance",
    with_ctes(
        "bars",
        f"""SELECT o.security_id, r.ticker, r.as_of_date, r.last_price, {', '.join(_fold('px', 'o.'))},
 CAST(len(px) AS INTEGER) AS advanced_bars, false AS needs_rebuild, NULL AS reason
 FROM old_state o JOIN (SELECT t.security_id, arg_max(t.ticker, t.date) AS ticker, max(t.date) AS as_of_date, arg_max(t.adj_close, t.date) AS last_price,
  coalesce(list(t.adj_close ORDER BY t.date) FILTER (WHERE t.date > s.as_of_date), []) AS px FROM tail t JOIN old_state s USING (security_id) GROUP BY 1) r
 USING (security_id)""",
        old_state=_OLD,
        tail=_TAIL,
    ),
)
def ema_advance(spark, folder):
    return E.ema_advance(_old_state(spark, folder), _ready(spark, folder), UNIQUE)


def _mixed_state(spark, folder, bars=None):
    """State of the suppliers with history: some prices disagree, the rest is older or current."""
    old = _old_state(spark, folder, bars).join(fx.history_ids(spark, folder), "security_id", "left_semi")
    moved = F.col("last_price") > F.col("ema20") * 1.5
    return old.withColumn("last_price", F.when(moved, F.col("last_price") + 1).otherwise(F.col("last_price")))


_ROUTE = """SELECT i.security_id, CASE WHEN o.security_id IS NULL THEN 'bootstrap'
 WHEN l.security_id IS NOT NULL OR o.last_price > o.ema20 * 1.5 THEN 'rebuild'
 WHEN i.d > o.as_of_date THEN 'recursive' ELSE 'unchanged' END AS route
 FROM (SELECT security_id, max(date) AS d FROM bars GROUP BY 1) i
 LEFT JOIN (SELECT * FROM old_state WHERE security_id IN (SELECT security_id FROM history_ids)) o USING (security_id)
 LEFT JOIN (SELECT DISTINCT security_id FROM lifecycle) l ON i.security_id = l.security_id"""


@query(
    "ema_update",
    with_ctes(
        "bars history_ids lifecycle",
        "SELECT f.*, route, NULL AS error FROM fresh f JOIN routes USING (security_id)",
        old_state=_OLD,
        routes=_ROUTE,
        fresh=bootstrap_sql("bars"),
    ),
)
def ema_update(spark, folder):
    hints = fx.lifecycle(spark, folder).select("security_id")
    return E.ema_update(_ready(spark, folder), fx.bars(spark, folder), _mixed_state(spark, folder), hints, UNIQUE)


@query(
    "ema_state_checks",
    with_ctes(
        "bars",
        """SELECT count(*) AS state_rows, CAST(0 AS BIGINT) AS repeated_ids, CAST(0 AS BIGINT) AS null_rows,
 count(*) FILTER (WHERE last_price > ema200 * 1.5) AS bad_number_rows, count(*) FILTER (WHERE last_price > ema200 * 1.5) = 0 AS valid FROM state""",
        state=bootstrap_sql("bars"),
    ),
)
def ema_state_checks(spark, folder):
    broken = F.when(F.col("last_price") > F.col("ema200") * 1.5, -F.col("ema200")).otherwise(F.col("ema200"))
    return E.ema_state_checks(all_state(spark, folder).withColumn("ema200", broken))


SAMPLE = 20


@query(
    "required_plus_sample",
    with_ctes(
        "bars lifecycle",
        f"""SELECT security_id, 'required' AS selection, 'required_plus_sample' AS mode FROM state WHERE security_id IN (SELECT security_id FROM lifecycle)
 UNION ALL (SELECT security_id, 'sample', 'required_plus_sample' FROM state WHERE security_id NOT IN (SELECT security_id FROM lifecycle) ORDER BY 1 LIMIT {SAMPLE})""",
        state="SELECT DISTINCT security_id FROM bars",
    ),
)
def required_plus_sample(spark, folder):
    return E.required_plus_sample(fx.bars(spark, folder), fx.lifecycle(spark, folder), SAMPLE)


def _equivalence(spark, folder):
    """Carried-on state, drifted for some securities, against a full recomputation."""
    carried = E.ema_advance(_old_state(spark, folder), _ready(spark, folder), UNIQUE).select(*EMA_STATE_COLUMNS)
    drift = F.when(F.col("last_price") > F.col("ema200") * 1.5, F.col("ema50") * 1.001).otherwise(F.col("ema50"))
    candidate = carried.withColumn("ema50", drift)
    return E.ema_equivalence(
        candidate, fx.bars(spark, folder), candidate.select("security_id"), date(2001, 12, 31), unique_keys=UNIQUE
    )


_EQUIV = f"""SELECT security_id, CASE WHEN drifted THEN abs(ema50 * 1.001 - ema50) ELSE 0.0 END AS max_abs_error,
 CASE WHEN drifted THEN 'ema50' ELSE '' END AS failed_fields, CASE WHEN drifted THEN 1 ELSE 0 END AS numeric_failures,
 {TREND} <> {TREND.replace('ema50', '(CASE WHEN drifted THEN ema50 * 1.001 ELSE ema50 END)')} AS class_mismatch
 FROM (SELECT *, last_price > ema200 * 1.5 AS drifted FROM fresh)"""


@query("ema_equivalence", with_ctes("bars", f"SELECT * FROM ({_EQUIV})", fresh=bootstrap_sql("bars")))
def ema_equivalence(spark, folder):
    return _equivalence(spark, folder).drop("max_relative_error")


@query(
    "ema_equivalence_report",
    with_ctes(
        "bars",
        """SELECT count(*) AS verified, max(max_abs_error) AS max_abs_error, CAST(sum(numeric_failures) AS BIGINT) AS numeric_failures,
 count(*) FILTER (WHERE class_mismatch) AS classification_mismatches, sum(numeric_failures) = 0 AND NOT bool_or(class_mismatch) AS passed FROM equiv""",
        fresh=bootstrap_sql("bars"),
        equiv=_EQUIV,
    ),
)
def ema_equivalence_report(spark, folder):
    return E.ema_equivalence_report(_equivalence(spark, folder)).drop("max_relative_error")


@query(
    "rebuild_hints",
    with_ctes(
        "bars lifecycle",
        """SELECT security_id FROM equiv WHERE numeric_failures > 0 OR class_mismatch UNION SELECT security_id FROM lifecycle""",
        fresh=bootstrap_sql("bars"),
        equiv=_EQUIV,
    ),
)
def rebuild_hints(spark, folder):
    return E.rebuild_hints(_equivalence(spark, folder), fx.lifecycle(spark, folder))


# --- signals, checked with a recursive walk over numbered bars
_SIGNAL_WALK = """WITH RECURSIVE keyed AS (SELECT 1), %s,
 numbered AS (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date) AS rn FROM bars),
 walk AS (
  SELECT s.signal_id, s.security_id, s.strategy, s.entry_price AS entry, s.stop_loss AS stop, s.take_profit AS target, n.rn, 0 AS step,
   'pending' AS status, CAST(0 AS INTEGER) AS days, CAST(NULL AS DOUBLE) AS fill, CAST(NULL AS DOUBLE) AS xit, CAST(NULL AS VARCHAR) AS missed
  FROM signals s JOIN numbered n ON s.security_id = n.security_id AND s.signal_date = n.date
  UNION ALL
  SELECT signal_id, security_id, strategy, entry, stop, target, rn, step,
   CASE WHEN status = 'pending' THEN CASE WHEN trig AND stopped THEN 'sl_hit' WHEN stopped THEN 'missed' WHEN trig THEN 'entered' WHEN nd >= 3 THEN 'missed' ELSE 'pending' END
    ELSE CASE WHEN stopped THEN 'sl_hit' WHEN h >= target THEN 'tp_hit' WHEN nd >= 10 THEN 'closed_timeout' ELSE 'entered' END END,
   CASE WHEN status = 'pending' AND trig THEN 0 ELSE nd END,
   CASE WHEN status = 'pending' AND trig THEN newfill ELSE fill END,
   CASE WHEN status = 'pending' THEN CASE WHEN trig AND stopped THEN least(stopfill, newfill) ELSE xit END
    ELSE CASE WHEN stopped THEN stopfill WHEN h >= target THEN target WHEN nd >= 10 THEN CAST(printf('%%.2f', c) AS DOUBLE) ELSE xit END END,
   CASE WHEN status = 'pending' AND NOT trig AND stopped THEN 'sl_hit_before_entry' WHEN status = 'pending' AND NOT trig AND nd >= 3 THEN 'expired'
    WHEN status = 'pending' AND stopped AND NOT trig THEN 'sl_hit_before_entry' ELSE missed END
  FROM (SELECT w.signal_id, w.security_id, w.strategy, w.entry, w.stop, w.target, b.rn, w.step + 1 AS step, w.status, w.days + 1 AS nd, w.fill, w.xit, w.missed,
    b.high AS h, b.close AS c, CASE WHEN w.strategy = 'breakout' THEN b.high >= w.entry ELSE b.low <= w.entry END AS trig, b.low <= w.stop AS stopped,
    CAST(printf('%%.2f', CASE WHEN w.strategy = 'breakout' THEN greatest(b.open, w.entry) ELSE least(b.open, w.entry) END) AS DOUBLE) AS newfill,
    CAST(printf('%%.2f', least(b.open, w.stop)) AS DOUBLE) AS stopfill
   FROM walk w JOIN numbered b ON b.security_id = w.security_id AND b.rn = w.rn + 1 WHERE w.status IN ('pending', 'entered'))
 )
 SELECT signal_id, status, days AS days_in_status, fill AS entry_price_actual, xit AS exit_price, missed AS missed_reason
 FROM walk QUALIFY row_number() OVER (PARTITION BY signal_id ORDER BY step DESC) = 1"""


@query("signal_outcomes", _SIGNAL_WALK % with_ctes("bars signals", "").removeprefix("WITH ").strip())
def signal_outcomes(spark, folder):
    return G.signal_outcomes(fx.signals(spark, folder), fx.bars(spark, folder))


# --- splits and identity
_CLASS = """CASE WHEN split_factor IS NULL THEN 'null_split_factor' WHEN try_cast(split_factor AS DOUBLE) IS NULL THEN 'non_numeric_split_factor'
 WHEN try_cast(split_factor AS DOUBLE) <= 0 THEN 'invalid_split_factor' WHEN try_cast(split_factor AS DOUBLE) = 1 THEN 'none' ELSE 'event' END"""


@query("split_extract", with_ctes("splits", f"SELECT security_id, date, split_factor, provider_ticker, {_CLASS} AS event_class FROM splits"))
def split_extract(spark, folder):
    return K.split_extract(fx.splits(spark, folder)).drop("factor")


@query(
    "split_event_issues",
    with_ctes(
        "splits",
        """SELECT security_id, effective_date, split_factor, CASE WHEN split_factor > 0 AND split_factor <> 1 THEN 'identity_required' ELSE
 CASE WHEN provider_ticker IS NULL THEN 'identity_required' ELSE 'invalid_split_factor' END END AS issue
 FROM (SELECT security_id, date AS effective_date, try_cast(split_factor AS DOUBLE) AS split_factor,
   CASE WHEN day(date) = 1 THEN NULL ELSE provider_ticker END AS provider_ticker FROM splits)
 WHERE provider_ticker IS NULL OR NOT coalesce(split_factor > 0 AND split_factor <> 1, false)""",
    ),
)
def split_event_issues(spark, folder):
    stated = fx.splits(spark, folder).select(
        "security_id",
        F.col("date").alias("effective_date"),
        F.col("split_factor").try_cast("double").alias("split_factor"),
        F.when(F.dayofmonth("date") != 1, F.col("provider_ticker")).alias("provider_ticker"),
    )
    return K.split_event_issues(stated).drop("provider_ticker")


_EVENTS = f"SELECT security_id, date AS effective_date, try_cast(split_factor AS DOUBLE) AS split_factor, provider_ticker FROM splits WHERE {_CLASS} = 'event'"


def _events(spark, folder):
    return K.split_events(fx.splits(spark, folder))


@query(
    "split_dedupe",
    with_ctes(
        "splits",
        """SELECT security_id, effective_date, min(split_factor) AS split_factor, max(split_factor) AS max_factor, min(provider_ticker) AS provider_ticker,
 count(*) AS statements, max(split_factor) - min(split_factor) > 1e-12 AS conflict FROM events_in GROUP BY 1, 2""",
        events_in=_EVENTS,
    ),
)
def split_dedupe(spark, folder):
    return K.split_dedupe(_events(spark, folder))


AS_OF = date(2000, 6, 30)


@query(
    "split_factor",
    with_ctes(
        "bars clean_splits",
        f"""SELECT b.security_id, b.date, f AS factor, b.close / f AS normalized_close, b.volume * f AS normalized_volume FROM
 (SELECT b.*, coalesce(list_reduce(list_prepend(CAST(1 AS DOUBLE), list_transform(list_filter(e.ev, lambda x: x.effective_date > b.date), lambda x: x.split_factor)), lambda acc, x: acc * x), 1.0) AS f
  FROM bars b LEFT JOIN (SELECT security_id, list({{'effective_date': effective_date, 'split_factor': split_factor}} ORDER BY effective_date) AS ev
   FROM clean_splits WHERE effective_date <= DATE '{AS_OF}' GROUP BY 1) e USING (security_id)) b""",
    ),
)
def split_factor(spark, folder):
    out = K.split_factor(fx.bars(spark, folder), fx.clean_splits(spark, folder), AS_OF)
    return out.select("security_id", "date", "factor", "normalized_close", "normalized_volume")


@query(
    "split_stats",
    with_ctes(
        "splits members",
        """SELECT CAST(sum(n) AS BIGINT) AS event_rows, count(*) AS securities, CAST(sum(fw) AS BIGINT) AS forward_events, CAST(sum(rv) AS BIGINT) AS reverse_events,
 (SELECT count(DISTINCT ticker) FROM members) AS tickers, (SELECT count(DISTINCT ticker) FROM members WHERE ticker NOT IN (SELECT provider_ticker FROM events_in)) AS gap_count,
 round((SELECT count(DISTINCT ticker) FROM members WHERE ticker NOT IN (SELECT provider_ticker FROM events_in)) / (SELECT count(DISTINCT ticker) FROM members), 6) AS gap_rate
 FROM (SELECT security_id, count(*) AS n, count(*) FILTER (WHERE f > 1) AS fw, count(*) FILTER (WHERE f < 1) AS rv
  FROM (SELECT security_id, effective_date, max(split_factor) AS f FROM events_in GROUP BY 1, 2) GROUP BY 1)""",
        events_in=_EVENTS,
    ),
)
def split_stats(spark, folder):
    events = _events(spark, folder)
    return K.split_stats(events, fx.members(spark, folder), events.select(F.col("provider_ticker").alias("ticker")))


def _providers(spark, folder):
    """Two providers' versions of the clean facts; each lacks some and differs in some."""
    base = fx.clean_splits(spark, folder)
    day = F.dayofmonth("effective_date")
    first = base.filter(day != 1)
    second = base.withColumn("split_factor", F.when(day == 2, F.col("split_factor") * 2).otherwise(F.col("split_factor")))
    return base.filter(day != 3), first, second


@query(
    "split_crosscheck",
    with_ctes(
        "clean_splits",
        """SELECT security_id, effective_date, CASE WHEN d <> 3 THEN f END AS expected_factor, CASE WHEN d <> 1 THEN f END AS first_factor,
 CASE WHEN d = 2 THEN f * 2 ELSE f END AS second_factor, d NOT IN (1, 2) AS cross_provider_match,
 CASE WHEN d = 3 THEN 'unexpected' WHEN d IN (1, 2) THEN 'FAIL' ELSE 'PASS' END AS status
 FROM (SELECT security_id, effective_date, split_factor AS f, day(effective_date) AS d FROM clean_splits)""",
    ),
)
def split_crosscheck(spark, folder):
    return K.split_crosscheck(*_providers(spark, folder))


_SPANS = """SELECT lower(trim(provider)) AS p, upper(trim(provider_ticker)) AS t, security_id, coalesce(valid_from, DATE '0001-01-01') AS a,
 coalesce(valid_to, DATE '9999-12-31') AS b FROM aliases"""


@query(
    "alias_overlaps",
    with_ctes(
        "aliases",
        """SELECT x.p AS provider, x.t AS provider_ticker, min(greatest(x.a, y.a)) AS first_overlap FROM spans x JOIN spans y
 ON x.p = y.p AND x.t = y.t AND x.security_id < y.security_id AND greatest(x.a, y.a) <= least(x.b, y.b) GROUP BY 1, 2""",
        spans=_SPANS,
    ),
)
def alias_overlaps(spark, folder):
    return K.alias_overlaps(fx.aliases(spark, folder))


def _alias_events(spark, folder):
    """Every bar as a provider event under its ticker."""
    return fx.bars(spark, folder).select(
        F.lit("EOD").alias("provider"), F.col("ticker").alias("provider_ticker"), F.col("date").alias("event_date")
    )


@query(
    "resolve_alias",
    with_ctes(
        "bars aliases",
        """SELECT 'EOD' AS provider, e.ticker AS provider_ticker, e.date AS event_date, CASE WHEN count(DISTINCT s.security_id) = 1 THEN min(s.security_id) END AS security_id,
 CASE WHEN count(DISTINCT s.security_id) = 1 THEN 'RESOLVED' ELSE 'UNRESOLVED' END AS resolution
 FROM bars e LEFT JOIN spans s ON s.p = 'eod' AND s.t = upper(e.ticker) AND e.date BETWEEN s.a AND s.b GROUP BY 1, 2, 3""",
        spans=_SPANS,
    ),
)
def resolve_alias(spark, folder):
    return K.resolve_alias(_alias_events(spark, folder), fx.aliases(spark, folder))


@query(
    "alias_issues",
    with_ctes(
        "aliases",
        """SELECT provider_ticker, security_id, CASE WHEN evidence IS NULL THEN 'lineage_field_missing' ELSE 'invalid_date_range' END AS issue FROM
 (SELECT provider_ticker, security_id, valid_from, CASE WHEN valid_to = DATE '2000-12-31' THEN DATE '1996-01-01' ELSE valid_to END AS valid_to,
   CASE WHEN valid_from = DATE '1997-12-01' THEN NULL ELSE evidence END AS evidence FROM aliases)
 WHERE evidence IS NULL OR valid_from > valid_to""",
    ),
)
def alias_issues(spark, folder):
    broken = fx.aliases(spark, folder).select(
        "security_id", "provider", "provider_ticker", "valid_from",
        F.when(F.col("valid_to") == date(2000, 12, 31), F.lit(date(1996, 1, 1))).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(F.col("valid_from") == date(1997, 12, 1), None).otherwise(F.col("evidence")).alias("evidence"),
    )
    return K.alias_issues(broken).select("provider_ticker", "security_id", "issue")


GATE_DAY = date(2001, 8, 1)


@query(
    "lifecycle_gate",
    with_ctes(
        "members lifecycle",
        f"""SELECT security_id, ticker, lifecycle_status,
 NOT coalesce(lifecycle_status IN ('VERIFIED_TERMINATED_PUBLIC_LISTING', 'VERIFIED_NONTRADABLE_PRIMARY_EXCHANGE') AND effective_date <= DATE '{GATE_DAY}', false) AS allowed,
 CASE WHEN lifecycle_status = 'VERIFIED_TICKER_CHANGE_SAME_SECURITY' AND effective_date <= DATE '{GATE_DAY}' THEN successor_ticker ELSE ticker END AS acquisition_ticker
 FROM members LEFT JOIN lifecycle USING (security_id)""",
    ),
)
def lifecycle_gate(spark, folder):
    members = fx.members(spark, folder).select("security_id", "ticker")
    return K.lifecycle_gate(members, fx.lifecycle(spark, folder), GATE_DAY)


@query(
    "provider_symbol",
    with_ctes(
        "members lifecycle",
        """SELECT security_id, m.t AS ticker, coalesce(l.symbol, replace(upper(trim(m.t)), '.', '-')) AS symbol
 FROM (SELECT security_id, ' ' || lower(ticker) || '.a' AS t FROM members) m
 LEFT JOIN (SELECT security_id, successor_ticker AS symbol FROM lifecycle WHERE effective_date IS NULL) l USING (security_id)""",
    ),
)
def provider_symbol(spark, folder):
    members = fx.members(spark, folder).select(
        "security_id", F.concat(F.lit(" "), F.lower("ticker"), F.lit(".a")).alias("ticker")
    )
    reviewed = (
        fx.lifecycle(spark, folder)
        .filter(F.col("effective_date").isNull())
        .select("security_id", F.col("successor_ticker").alias("symbol"))
        .join(members, "security_id")
    )
    return K.provider_symbol(members, reviewed)


