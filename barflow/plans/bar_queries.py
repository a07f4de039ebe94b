"""Queries over bars: QC, normalisation, merges, windows, continuity, reconciliation."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from barflow.functions import exprs as X
from barflow.operators import continuity as C
from barflow.operators import merge as M
from barflow.operators import normalize as N
from barflow.operators import reconcile as R
from barflow.operators import snapshots as S
from barflow.operators import tails as TL
from barflow.operators import windows as W
from barflow.plans import fixtures as fx
from barflow.plans.catalog import query
from barflow.plans.fixtures import with_ctes
from barflow.schemas import BAR_COLUMNS, BAR_VALUES
from barflow.session import clustered, materialize, new_folder
from barflow.sinks.store import append_to_bar_store, create_bar_store

BARS = ", ".join(BAR_COLUMNS)


def _bad(col: str) -> str:
    return f"(isnan(CAST({col} AS DOUBLE)) OR isinf(CAST({col} AS DOUBLE)))"


def qc_sql(fields=tuple(BAR_VALUES), high="high_below_open_close_or_low", low="low_above_open_close_or_high") -> str:
    """SQL text of the rule list as a ``|``-joined string."""
    null = " OR ".join(f"{f} IS NULL" for f in fields)
    nonfinite = " OR ".join(_bad(f) for f in fields)
    nonpos = " OR ".join(f"{f} <= 0" for f in fields if f != "volume")
    return (
        f"CASE WHEN {null} THEN 'missing_or_nonnumeric' WHEN {nonfinite} THEN 'nonfinite' ELSE"
        f" array_to_string(list_filter([CASE WHEN {nonpos} THEN 'nonpositive_price' END,"
        f" CASE WHEN volume < 0 THEN 'negative_volume' END,"
        f" CASE WHEN high < greatest(open, close, low) THEN '{high}' END,"
        f" CASE WHEN low > least(open, close, high) THEN '{low}' END], lambda x: x IS NOT NULL), '|') END"
    )


RANGE_SQL = (
    "CASE WHEN " + " OR ".join(f"{f} IS NULL OR {_bad(f)}" for f in BAR_VALUES) + " THEN 'nonfinite_or_missing' ELSE"
    " array_to_string(list_filter([CASE WHEN open > high THEN 'open_above_high' END,"
    " CASE WHEN open < low THEN 'open_below_low' END,"
    " CASE WHEN close > high OR close < low THEN 'close_outside_range' END], lambda x: x IS NOT NULL), '|') END"
)
SHORT = ("open", "high", "low", "close", "volume")


def _issue_query(name: str, issues, sql_text: str) -> None:
    body = f"SELECT security_id, date, issues FROM (SELECT *, {sql_text} AS issues FROM dirty_bars) WHERE issues <> ''"

    @query(name, with_ctes("dirty_bars", body))
    def run(spark, folder):
        rows = fx.dirty_bars(spark, folder).select("security_id", "date", X.joined(issues()).alias("issues"))
        return rows.filter(F.col("issues") != "")


_issue_query("qc_issues", X.qc_issues, qc_sql())
_issue_query("qc_issues_no_adj", X.qc_issues_no_adj, qc_sql(SHORT))
_issue_query("qc_issues_short", X.qc_issues_short, qc_sql(SHORT, "high_below_range", "low_above_range"))
_issue_query("qc_range", X.qc_range, RANGE_SQL)


@query("qc_gate", with_ctes("dirty_bars", f"SELECT count(*) AS bars, count(*) FILTER (WHERE {qc_sql()} <> '') AS rejected FROM dirty_bars"))
def qc_gate(spark, folder):
    return N.qc_gate(fx.dirty_bars(spark, folder))


_RAW_COMPLETE = (
    "SELECT date, security_id, ticker, open, high, low, close, adj_close, coalesce(volume, 0) AS volume, src_ord"
    " FROM raw_rows WHERE date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL"
    " AND close IS NOT NULL"
)
_RAW_LAST = "SELECT * FROM complete QUALIFY row_number() OVER (PARTITION BY security_id, date ORDER BY src_ord DESC) = 1"
_NORMAL = f"""SELECT {BARS}, CASE WHEN max(CASE WHEN least(open, high, low, close) < 0 THEN 1 ELSE 0 END) OVER w = 1
 THEN 'negative_price' WHEN max(CASE WHEN high < low THEN 1 ELSE 0 END) OVER w = 1 THEN 'high_below_low'
 WHEN max(CASE WHEN {qc_sql()} <> '' THEN 1 ELSE 0 END) OVER w = 1 THEN 'qc_rejected' ELSE 'accepted' END AS verdict
 FROM deduped WINDOW w AS (PARTITION BY security_id)"""


@query("normalize_history", with_ctes("raw_rows", _NORMAL, complete=_RAW_COMPLETE, deduped=_RAW_LAST))
def normalize_history(spark, folder):
    return N.normalize_history(fx.raw_rows(spark, folder))


@query("dedupe_keep", with_ctes("raw_rows", "SELECT * FROM raw_rows QUALIFY row_number() OVER (PARTITION BY security_id, date ORDER BY src_ord) = 1"))
def dedupe_keep(spark, folder):
    return N.dedupe_keep(fx.raw_rows(spark, folder), ["security_id", "date"], ["src_ord"], keep="first")


def _index_rows(spark, folder):
    k = fx.keyed_bars(spark, folder)
    return k.select(
        F.col("security_id").alias("index_id"), F.col("ticker").alias("source_symbol"), "date", "open",
        F.expr("CASE WHEN suppkey % 10 = 2 AND n % 97 = 0 THEN low * 0.5D ELSE high END").alias("high"),
        "low", "close",
        F.expr("CASE WHEN n % 31 = 0 THEN NULL WHEN suppkey % 10 = 0 AND n % 50 = 1 THEN -5.0D ELSE cast(volume as double) END").alias("volume"),
        F.expr("cast(CASE WHEN suppkey % 10 = 1 AND n % 101 = 0 THEN 0 ELSE datediff(date, DATE'1995-01-01') * 2 END as bigint)").alias("src_ord"),
    )


_INDEX_ROWS = """SELECT security_id AS index_id, ticker AS source_symbol, date, open,
 CASE WHEN suppkey % 10 = 2 AND n % 97 = 0 THEN low * 0.5 ELSE high END AS high, low, close,
 CASE WHEN n % 31 = 0 THEN NULL WHEN suppkey % 10 = 0 AND n % 50 = 1 THEN -5.0 ELSE CAST(volume AS DOUBLE) END AS volume,
 CASE WHEN suppkey % 10 = 1 AND n % 101 = 0 THEN 0 ELSE date_diff('day', DATE '1995-01-01', date) * 2 END AS src_ord
 FROM keyed_bars"""
_INDEX_JUDGED = """SELECT *, max(CASE WHEN volume < 0 THEN 1 ELSE 0 END) OVER p AS bad_volume,
 max(CASE WHEN prev >= date THEN 1 ELSE 0 END) OVER p AS bad_order,
 max(CASE WHEN high < greatest(open, low, close) OR low > least(open, high, close) THEN 1 ELSE 0 END) OVER p AS bad_env
 FROM (SELECT *, lag(date) OVER (PARTITION BY index_id ORDER BY src_ord, date DESC) AS prev FROM index_rows WHERE volume IS NOT NULL)
 WINDOW p AS (PARTITION BY index_id)"""


@query(
    "normalize_index_bars",
    with_ctes(
        "keyed_bars",
        """SELECT index_id, count(*) AS bars, min(date) AS first_date, max(date) AS last_date, source_provider, verdict
 FROM (SELECT *, 'PROVIDER' AS source_provider, CASE WHEN bad_volume = 1 THEN 'negative_volume'
   WHEN bad_order = 1 THEN 'date_chronology' WHEN bad_env = 1 THEN 'ohlc_envelope' ELSE 'accepted' END AS verdict
   FROM judged) GROUP BY index_id, source_provider, verdict""",
        index_rows=_INDEX_ROWS,
        judged=_INDEX_JUDGED,
    ),
)
def normalize_index_bars(spark, folder):
    out = N.normalize_index_bars(_index_rows(spark, folder), "PROVIDER", "v1")
    return out.groupBy("index_id", "source_provider", "verdict").agg(
        F.count("*").alias("bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query(
    "monotonic_check",
    with_ctes(
        "keyed_bars",
        """SELECT index_id, CAST(count(*) AS BIGINT) AS rows,
 CAST(count(*) FILTER (WHERE prev >= date) AS BIGINT) AS inversions, count(*) FILTER (WHERE prev >= date) = 0 AS strictly_increasing
 FROM (SELECT *, lag(date) OVER (PARTITION BY index_id ORDER BY ord) AS prev FROM
   (SELECT *, src_ord * 100000 + date_diff('day', DATE '1995-01-01', date) AS ord FROM index_rows)) GROUP BY index_id""",
        index_rows=_INDEX_ROWS,
    ),
)
def monotonic_check(spark, folder):
    days = F.datediff("date", F.lit("1995-01-01").cast("date"))
    rows = _index_rows(spark, folder).withColumn("ord", F.col("src_ord") * 100000 + days)
    return N.monotonic_check(rows, ["index_id"], "date", "ord", segment_rows=100_000_000)


_INCOMPLETE = "SELECT *, CASE WHEN date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL THEN 1 ELSE 0 END AS ok FROM raw_rows"


@query(
    "split_incomplete",
    with_ctes(
        "raw_rows",
        """SELECT security_id, CAST(sum(v) AS BIGINT) AS valid_rows, CAST(sum(d) AS BIGINT) AS discarded_rows,
 count(*) FILTER (WHERE v > 1) AS duplicate_valid_dates
 FROM (SELECT security_id, date, sum(ok) AS v, sum(1 - ok) AS d FROM labelled GROUP BY 1, 2) GROUP BY 1""",
        labelled=_INCOMPLETE,
    ),
)
def split_incomplete(spark, folder):
    return N.split_incomplete_checks(N.split_incomplete(fx.raw_rows(spark, folder)))


# events fall in January, when New York is five hours behind UTC
_CUTOFF = "SELECT CAST(max(ts) - INTERVAL 5 HOUR - INTERVAL 1050 MINUTE AS DATE) FROM events"


def _last_event_cutoff(spark, folder):
    last = fx.table(spark, folder, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("ts")).select("ts")
    return X.finalized_through(last.scalar())


@query("finalized_filter", with_ctes("event_bars", f"SELECT {BARS} FROM event_bars WHERE date <= ({_CUTOFF})"))
def finalized_filter(spark, folder):
    return N.finalized_filter(fx.event_bars(spark, folder), _last_event_cutoff(spark, folder))


@query(
    "finalized_excluded",
    "SELECT CAST(ts AS DATE) AS date, count(*) AS excluded_rows FROM events"
    " WHERE CAST(ts AS DATE) > CAST(ts - INTERVAL 5 HOUR - INTERVAL 1050 MINUTE AS DATE) GROUP BY 1",
)
def finalized_excluded(spark, folder):
    ts = F.col("ts").cast("timestamp")
    rows = fx.table(spark, folder, "events").select(ts.cast("date").alias("date"), ts.alias("ts"))
    return N.finalized_excluded(rows, X.finalized_through("ts"))


SESSION = date(1998, 6, 10)


@query(
    "select_session",
    with_ctes(
        "raw_rows",
        f"""SELECT security_id, DATE '{SESSION}' AS date, n AS row_count,
 CASE WHEN n <> 1 THEN 'NO_SINGLE_COMPLETE_ROW' WHEN issues = '' THEN 'VALID' ELSE 'INVALID' END AS session_class,
 CASE WHEN n = 1 THEN issues END AS issues, CASE WHEN n = 1 THEN close END AS close, CASE WHEN n = 1 THEN volume END AS volume
 FROM (SELECT security_id, count(*) AS n, min({qc_sql()}) AS issues, min(close) AS close, min(volume) AS volume
   FROM raw_rows WHERE date = DATE '{SESSION}' GROUP BY 1)""",
    ),
)
def select_session(spark, folder):
    out = N.select_session(fx.raw_rows(spark, folder), SESSION)
    return out.select("security_id", "date", "row_count", "session_class", "issues", "close", "volume")


_BATCH_OK = f"SELECT security_id, max(CASE WHEN verdict = 'accepted' THEN 1 ELSE 0 END) AS ok FROM ({_NORMAL}) GROUP BY 1"


@query(
    "batch_then_single",
    with_ctes(
        "raw_rows bars",
        f"""SELECT {BARS}, 'batch' AS source FROM deduped WHERE security_id IN (SELECT security_id FROM batch WHERE ok = 1)
 UNION ALL SELECT {BARS}, 'single' AS source FROM provider_part WHERE security_id NOT IN (SELECT security_id FROM batch WHERE ok = 1)""",
        complete=_RAW_COMPLETE,
        deduped=_RAW_LAST,
        batch=_BATCH_OK,
        provider_part="SELECT * FROM bars",
    ),
)
def batch_then_single(spark, folder):
    single = fx.bars(spark, folder).withColumn("src_ord", F.lit(0))
    return N.batch_then_single(fx.raw_rows(spark, folder), single)


@query(
    "adjusted_ohlc",
    with_ctes(
        "dirty_bars",
        """SELECT security_id, date, open * f AS open, high * f AS high, low * f AS low, close * f AS close, f AS adjustment_factor,
 CASE WHEN f IS NULL OR isnan(f) OR isinf(f) OR f <= 0 THEN 'invalid_adjustment_factor'
  WHEN least(open * f, high * f, low * f, close * f) <= 0 THEN 'adjusted_nonfinite_or_nonpositive'
  WHEN high * f < greatest(open * f, low * f, close * f) THEN 'adjusted_high_violates_range'
  WHEN low * f > least(open * f, high * f, close * f) THEN 'adjusted_low_violates_range' END AS adjust_issue
 FROM (SELECT *, adj_close / close AS f FROM dirty_bars)""",
    ),
)
def adjusted_ohlc(spark, folder):
    return N.adjusted_ohlc(fx.dirty_bars(spark, folder)).select(
        "security_id", "date", "open", "high", "low", "close", "adjustment_factor", "adjust_issue"
    )


@query(
    "failure_rate_gate",
    """SELECT attempted, failed, failed / attempted AS failure_rate, failed / attempted <= 0.10 AS publish_allowed
 FROM (SELECT count(*) FILTER (WHERE o_orderstatus <> 'P') AS attempted,
  count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS failed FROM orders)""",
)
def failure_rate_gate(spark, folder):
    failed = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    status = F.when(F.col("o_orderstatus") == "P", "skipped").when(failed, "failed").otherwise("uploaded")
    return N.failure_rate_gate(fx.table(spark, folder, "orders").select(status.alias("status")))


@query(
    "nth_bar",
    with_ctes(
        "dirty_bars members",
        f"""SELECT t.security_id, t.position, b.date, b.close,
 CASE WHEN b.date IS NULL THEN 'outside_history' WHEN b.ticker IS DISTINCT FROM t.ticker THEN 'identity_differs'
  WHEN NOT contains(b.issues, 'nonfinite') THEN 'rule_not_found' ELSE 'confirmed' END AS outcome
 FROM (SELECT security_id, ticker, suppkey + 480 AS position FROM members) t LEFT JOIN
 (SELECT *, {qc_sql()} AS issues, row_number() OVER (PARTITION BY security_id ORDER BY date) - 1 AS position FROM dirty_bars) b
 ON t.security_id = b.security_id AND t.position = b.position""",
    ),
)
def nth_bar(spark, folder):
    targets = fx.members(spark, folder).select(
        "security_id", "ticker", (F.col("suppkey") + 480).alias("position"), F.lit("nonfinite").alias("expected_rule")
    )
    return N.nth_bar(fx.dirty_bars(spark, folder), targets).select("security_id", "position", "date", "close", "outcome")


@query(
    "index_source_checks",
    with_ctes(
        "dirty_bars",
        """SELECT o.security_id AS index_id, o.rows, first_date, last_date, true AS dates_parseable, true AS dates_unique, true AS dates_monotonic,
 t.sample_rows, t.recent_ohlc_complete, t.recent_ohlc_valid, t.recent_volume_complete,
 t.recent_volume_nonnegative, t.some_volume AS recent_volume_not_all_zero, t.recent_volume_varies, true AS nonempty,
 volume_recent_min, volume_recent_max, volume_recent_unique,
 CASE WHEN t.recent_ohlc_complete AND t.recent_ohlc_valid AND t.recent_volume_nonnegative AND t.recent_volume_varies
  AND t.some_volume THEN 'PASS' ELSE 'FAIL' END AS status
 FROM (SELECT security_id, count(*) AS rows, min(date) AS first_date, max(date) AS last_date FROM dirty_bars GROUP BY 1) o JOIN
 (SELECT security_id, count(*) AS sample_rows, bool_and(close IS NOT NULL) AS recent_ohlc_complete,
   bool_and(coalesce(high >= greatest(open, close, low) AND low <= least(open, close, high)
     AND least(open, high, low, close) > 0, false) AND close IS NOT NULL) AS recent_ohlc_valid,
   bool_and(volume IS NOT NULL) AS recent_volume_complete, bool_and(volume >= 0) AS recent_volume_nonnegative, count(DISTINCT volume) >= 2 AS recent_volume_varies,
   bool_or(volume > 0) AS some_volume, CAST(min(volume) AS DOUBLE) AS volume_recent_min, CAST(max(volume) AS DOUBLE) AS volume_recent_max,
   count(DISTINCT volume) AS volume_recent_unique
  FROM (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS rn FROM dirty_bars) WHERE rn <= 60 GROUP BY 1) t
 ON o.security_id = t.security_id""",
    ),
)
def index_source_checks(spark, folder):
    rows = fx.dirty_bars(spark, folder).withColumnRenamed("security_id", "index_id")
    return N.index_source_checks(rows)


# --- merges: history ends on this day, the download overlaps it by two months
SPLIT_DAY = date(2001, 6, 30)
OVERLAP_DAY = date(2001, 5, 1)


def _history(spark, folder):
    return history_of(fx.bars(spark, folder))


def history_of(b):
    """Stored bars up to the split day, without the sessions of one internal week."""
    gap = F.col("date").between(date(2001, 5, 14), date(2001, 5, 18))
    return b.filter((F.col("date") <= SPLIT_DAY) & ~gap)


def _download(spark, folder):
    return fx.provider_b(spark, folder).filter(F.col("date") >= OVERLAP_DAY)


_HIST = f"SELECT {BARS} FROM bars WHERE date <= DATE '{SPLIT_DAY}' AND date NOT BETWEEN DATE '2001-05-14' AND DATE '2001-05-18'"
_DOWN = f"SELECT {BARS} FROM provider_b WHERE date >= DATE '{OVERLAP_DAY}'"
_NEW = "SELECT d.* FROM down d ANTI JOIN hist h ON d.security_id = h.security_id AND d.date = h.date"


@query(
    "merge_append",
    with_ctes("bars provider_b", f"SELECT {BARS} FROM hist UNION ALL SELECT {BARS} FROM new_rows", hist=_HIST, down=_DOWN, new_rows=_NEW),
)
def merge_append(spark, folder):
    return M.merge_append(_history(spark, folder), _download(spark, folder))


@query(
    "merge_append_rows",
    with_ctes(
        "bars provider_b",
        """SELECT n.security_id, n.date, CASE WHEN n.date <= l.d THEN 'backfill' ELSE 'addition' END AS merge_class
 FROM new_rows n LEFT JOIN (SELECT security_id, max(date) AS d FROM hist GROUP BY 1) l USING (security_id)""",
        hist=_HIST, down=_DOWN, new_rows=_NEW,
    ),
)
def merge_append_rows(spark, folder):
    return M.merge_append_rows(_history(spark, folder), _download(spark, folder)).select("security_id", "date", "merge_class")


def _exact_inputs(spark, folder):
    """Each security is asked for every session of the internal gap that traded anywhere."""
    b = fx.bars(spark, folder)
    week = b.filter(F.col("date").between(date(2001, 5, 14), date(2001, 5, 18)))
    wanted = week.select("security_id", "date")
    # rows offered: those with a trade of one day's span or later in the week
    offered = week.filter((F.col("volume") > 5) | (F.col("date") > date(2001, 5, 15)))
    return _history(spark, folder), offered, wanted


_WEEK = f"SELECT {BARS} FROM bars WHERE date BETWEEN DATE '2001-05-14' AND DATE '2001-05-18'"
_OFFER = "SELECT * FROM week WHERE volume > 5 OR date > DATE '2001-05-15'"
_SHORT = "SELECT DISTINCT w.security_id FROM week w ANTI JOIN offered o ON w.security_id = o.security_id AND w.date = o.date"


@query(
    "merge_exact",
    with_ctes(
        "bars",
        f"""SELECT {BARS} FROM hist UNION ALL
 SELECT {BARS} FROM offered WHERE security_id NOT IN (SELECT security_id FROM short_ids)""",
        hist=_HIST, week=_WEEK, offered=_OFFER, short_ids=_SHORT,
    ),
)
def merge_exact(spark, folder):
    history, offered, wanted = _exact_inputs(spark, folder)
    return M.merge_exact(history, offered, wanted)


@query(
    "merge_exact_violations",
    with_ctes("bars", "SELECT security_id, 'repair_rows_do_not_match_targets' AS reason FROM short_ids", week=_WEEK, offered=_OFFER, short_ids=_SHORT),
)
def merge_exact_violations(spark, folder):
    history, offered, wanted = _exact_inputs(spark, folder)
    return M.merge_exact_violations(history, offered, wanted)


@query(
    "preservation_check",
    with_ctes("bars provider_b", "SELECT CAST(0 AS BIGINT) AS lost_rows, count(*) AS added_rows FROM new_rows", hist=_HIST, down=_DOWN, new_rows=_NEW),
)
def preservation_check(spark, folder):
    history = _history(spark, folder)
    return M.preservation_check(history, M.merge_append(history, _download(spark, folder)))


def _bad_evidence(spark, folder):
    keyed = clustered(fx.keyed_bars(spark, folder), "keyed")
    dirty = fx.dirtied(keyed)
    # the few bad bars are judged and written once: evidence and plan read them several times
    bad = materialize(N.qc_bad_bars(dirty).drop("issues"), "bad")
    # evidence of the negative-volume bars was taken before their close was corrected
    evidence = bad.withColumn("close", F.when(F.col("volume") < 0, F.col("close") + 1).otherwise(F.col("close")))
    # some evidence is handed in twice
    return dirty, evidence.unionByName(evidence.filter("day(date) <= 10")), keyed.select(*BAR_COLUMNS)


_PLAN = f"""SELECT security_id, date, CASE WHEN volume < 0 OR close IS NULL
 OR isnan(adj_close) OR isnan(close) THEN 'differs_from_evidence' ELSE 'replaced' END AS action
 FROM dirty_bars WHERE {qc_sql()} <> ''"""


@query("merge_replace_bad_plan", with_ctes("dirty_bars", _PLAN))
def merge_replace_bad_plan(spark, folder):
    return M.merge_replace_bad_plan(*_bad_evidence(spark, folder)).select("security_id", "date", "action")


@query(
    "merge_replace_bad",
    with_ctes(
        "dirty_bars bars",
        """SELECT d.date, d.security_id, d.ticker, CASE WHEN p.action = 'replaced' THEN b.open ELSE d.open END AS open,
 CASE WHEN p.action = 'replaced' THEN b.high ELSE d.high END AS high, CASE WHEN p.action = 'replaced' THEN b.low ELSE d.low END AS low,
 CASE WHEN p.action = 'replaced' THEN b.close ELSE d.close END AS close, CASE WHEN p.action = 'replaced' THEN b.adj_close ELSE d.adj_close END AS adj_close,
 CASE WHEN p.action = 'replaced' THEN b.volume ELSE d.volume END AS volume
 FROM dirty_bars d LEFT JOIN plan p ON d.security_id = p.security_id AND d.date = p.date
 LEFT JOIN bars b ON d.security_id = b.security_id AND d.date = b.date""",
        plan=_PLAN,
    ),
)
def merge_replace_bad(spark, folder):
    return M.merge_replace_bad(*_bad_evidence(spark, folder))


UPSERT_DAY = date(1999, 3, 3)


@query(
    "merge_upsert_date",
    with_ctes(
        "bars provider_b",
        f"SELECT {BARS} FROM bars WHERE date <> DATE '{UPSERT_DAY}' UNION ALL SELECT {BARS} FROM provider_b WHERE date = DATE '{UPSERT_DAY}'",
    ),
)
def merge_upsert_date(spark, folder):
    return M.merge_upsert_date(fx.bars(spark, folder), fx.provider_b(spark, folder), UPSERT_DAY)


@query(
    "merge_upsert_date_report",
    with_ctes(
        "provider_a provider_b",
        f"""SELECT b.security_id, {', '.join(f'b.{c} AS after_{c}, a.{c} AS before_{c}' for c in BAR_VALUES)},
 CASE WHEN a.security_id IS NULL THEN 'added' WHEN {' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in BAR_VALUES)} THEN 'changed' ELSE 'same' END AS change
 FROM (SELECT * FROM provider_b WHERE date = DATE '{UPSERT_DAY}') b
 LEFT JOIN (SELECT * FROM provider_a WHERE date = DATE '{UPSERT_DAY}') a USING (security_id)""",
    ),
)
def merge_upsert_date_report(spark, folder):
    return M.merge_upsert_date_report(fx.provider_a(spark, folder), fx.provider_b(spark, folder), UPSERT_DAY)


def _restated(keyed):
    """Newer bars of every security: some with restated adjusted closes, some with revised closes."""
    k = keyed.filter(F.col("date") >= OVERLAP_DAY)
    return k.select(
        "date", "security_id", "ticker", "open",
        F.expr("CASE WHEN suppkey % 10 = 3 THEN high + 1 WHEN suppkey % 10 = 6 AND n % 9 = 0 THEN low * 0.5D ELSE high END")
        .alias("high"), "low",
        F.expr("CASE WHEN suppkey % 10 = 3 THEN close + 1 ELSE close END").alias("close"),
        F.expr("CASE WHEN suppkey % 10 = 3 THEN adj_close + 1 WHEN suppkey % 10 = 4 THEN adj_close * 0.5D"
               " WHEN suppkey % 10 = 5 AND n % 2 = 0 THEN adj_close * 0.5D ELSE adj_close END").alias("adj_close"),
        "volume",
    )


def _extended(spark, folder):
    """The stored and the newer bars."""
    keyed = clustered(fx.keyed_bars(spark, folder), "keyed")
    return keyed.select(*BAR_COLUMNS).filter(F.col("date") <= SPLIT_DAY), _restated(keyed)


_RESTATED = f"""SELECT date, security_id, ticker, open,
 CASE WHEN suppkey % 10 = 3 THEN high + 1 WHEN suppkey % 10 = 6 AND n % 9 = 0 THEN low * 0.5 ELSE high END AS high, low, CASE WHEN suppkey % 10 = 3 THEN close + 1 ELSE close END AS close,
 CASE WHEN suppkey % 10 = 3 THEN adj_close + 1 WHEN suppkey % 10 = 4 THEN adj_close * 0.5
  WHEN suppkey % 10 = 5 AND n % 2 = 0 THEN adj_close * 0.5 ELSE adj_close END AS adj_close, volume
 FROM keyed_bars WHERE date >= DATE '{OVERLAP_DAY}'"""
_STORED = f"SELECT {BARS} FROM bars WHERE date <= DATE '{SPLIT_DAY}'"
_close = lambda a, b: f"abs({a} - {b}) <= 1e-9 + 1e-7 * abs({b})"
_OVERLAP = f"""SELECT *, rn / ro AS rev, first_value(rn / ro) OVER (PARTITION BY security_id ORDER BY date) AS anchor FROM
 (SELECT o.security_id, o.date, o.close AS oc, n.close AS nc, o.adj_close / o.close AS ro, n.adj_close / n.close AS rn
  FROM stored o JOIN restated n ON o.security_id = n.security_id AND o.date = n.date)"""
_VERDICTS = f"""SELECT i.security_id, coalesce(n, 0) AS overlap_rows,
 CASE WHEN i.bad THEN 'invalid_bars' WHEN n IS NULL THEN 'no_overlap' WHEN NOT closes THEN 'historical_closes_revised' WHEN ratios THEN 'append'
  WHEN n >= 2 AND uniform THEN 'rebase' ELSE 'adjustment_basis_changed' END AS verdict,
 CASE WHEN NOT i.bad AND n IS NOT NULL AND closes AND NOT ratios AND n >= 2 AND uniform THEN anchor ELSE 1.0 END AS rebase_factor
 FROM (SELECT security_id, bool_or({qc_sql()} <> '') AS bad FROM (SELECT * FROM stored UNION ALL SELECT * FROM restated) GROUP BY 1) i LEFT JOIN
 (SELECT security_id, count(*) AS n, bool_and({_close('oc', 'nc')}) AS closes, bool_and({_close('ro', 'rn')}) AS ratios,
  bool_and({_close('rev', 'anchor')}) AS uniform, max(anchor) AS anchor FROM overlap_rows GROUP BY 1) c USING (security_id)"""


@query("benchmark_verdicts", with_ctes("bars keyed_bars", "SELECT * FROM verdicts", stored=_STORED, restated=_RESTATED, overlap_rows=_OVERLAP, verdicts=_VERDICTS))
def benchmark_verdicts(spark, folder):
    return M.benchmark_verdicts(*_extended(spark, folder))


@query(
    "benchmark_merge",
    with_ctes(
        "bars keyed_bars",
        f"""SELECT {BARS} FROM restated JOIN ok USING (security_id) UNION ALL
 SELECT s.date, s.security_id, s.ticker, s.open, s.high, s.low, s.close,
  CASE WHEN verdict = 'rebase' THEN s.adj_close * rebase_factor ELSE s.adj_close END AS adj_close, s.volume
 FROM stored s JOIN ok ON s.security_id = ok.security_id
 WHERE NOT EXISTS (SELECT 1 FROM restated r WHERE r.security_id = s.security_id AND r.date = s.date)""",
        stored=_STORED, restated=_RESTATED, overlap_rows=_OVERLAP, verdicts=_VERDICTS,
        ok="SELECT * FROM verdicts WHERE verdict IN ('append', 'rebase')",
    ),
)
def benchmark_merge(spark, folder):
    return M.benchmark_merge(*_extended(spark, folder))


# --- windows and readiness
_TAIL = f"SELECT {BARS} FROM bars QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 300"


@query("rolling_tail", with_ctes("bars", _TAIL))
def rolling_tail(spark, folder):
    return W.rolling_tail(fx.bars(spark, folder))


# Bars that arrive later: the last months, and days missing in between.
_LATE = "(date > DATE '2001-06-30' OR day(date) = 15)"
_WITHDRAWN = "day(date) = 3"


@query("bar_store_tail", with_ctes("bars", _TAIL))
def bar_store_tail(spark, folder):
    """Bars written to a store in two deliveries, the second with bars that it holds, and read in place."""
    bars = fx.bars(spark, folder)
    name = f"bar_store_{uuid.uuid4().hex}"
    create_bar_store(bars.filter(f"NOT {_LATE}"), name, new_folder(spark, "store"), 8)
    return W.rolling_tail(append_to_bar_store(spark, name, bars.filter(f"{_LATE} OR day(date) = 20")))


@query("tail_advance", with_ctes("bars", _TAIL))
def tail_advance(spark, folder):
    bars = fx.bars(spark, folder)
    tail = materialize(W.rolling_tail(bars.filter(f"NOT {_LATE}")), "tail")
    return TL.advance_tail(tail, bars.filter(_LATE))


@query(
    "tail_withdraw",
    with_ctes("bars", f"SELECT {BARS} FROM bars WHERE NOT ({_WITHDRAWN}) QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 300"),
)
def tail_withdraw(spark, folder):
    bars = fx.bars(spark, folder)
    tail = materialize(W.rolling_tail(bars), "tail")
    gone = bars.filter(_WITHDRAWN)
    return TL.withdraw_from_tail(tail, bars.filter(f"NOT ({_WITHDRAWN})"), gone)


READY_TARGET, READY_MINIMUM = 540, 530


def _operating_bars(spark, folder, bars=None):
    return (fx.bars(spark, folder) if bars is None else bars).join(fx.history_ids(spark, folder), "security_id", "left_semi")


def readiness_detail(spark, folder, bars=None):
    return W.readiness(
        fx.eligible_members(spark, folder), _operating_bars(spark, folder, bars),
        fx.lifecycle(spark, folder), READY_TARGET, READY_MINIMUM,
    )


READINESS = f"""SELECT m.security_id, m.ticker, coalesce(b.n, 0) AS available_bars, CASE WHEN b.n IS NULL THEN 0 ELSE least(b.n, {READY_TARGET}) END AS rolling_bars,
 b.first_rolling AS first_rolling_date, b.last_date,
 CASE WHEN b.n IS NULL AND m.security_id IN (SELECT security_id FROM lifecycle) THEN 'reviewed_no_retry'
  WHEN b.n IS NULL THEN 'unavailable' WHEN least(b.n, {READY_TARGET}) >= {READY_MINIMUM} THEN 'ready' ELSE 'insufficient' END AS status
 FROM eligible_members m LEFT JOIN (SELECT security_id, count(*) AS n, max(date) AS last_date,
  min(date) FILTER (WHERE rn <= {READY_TARGET}) AS first_rolling
  FROM (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS rn FROM bars
   WHERE security_id IN (SELECT security_id FROM history_ids)) GROUP BY 1) b USING (security_id)"""


@query("readiness", with_ctes("bars eligible_members lifecycle history_ids", READINESS))
def readiness(spark, folder):
    return readiness_detail(spark, folder)


@query("tail_readiness", with_ctes("bars eligible_members lifecycle history_ids", READINESS))
def tail_readiness(spark, folder):
    """Readiness from the stored window and counts after an update, without history."""
    bars = materialize(_operating_bars(spark, folder), "operating")
    old, new = bars.filter(f"NOT {_LATE}"), bars.filter(_LATE)
    tail = materialize(W.rolling_tail(old, READY_TARGET), "tail")
    counts = TL.advance_counts(materialize(TL.bar_counts(old), "counts"), new)
    return TL.readiness_from_tail(
        fx.eligible_members(spark, folder), TL.advance_tail(tail, new, READY_TARGET), counts,
        fx.lifecycle(spark, folder), READY_TARGET, READY_MINIMUM,
    )


SUMMARY = """SELECT count(*) AS confirmed_compliant, count(*) FILTER (WHERE status IN ('ready', 'insufficient')) AS included_in_rolling,
 count(*) FILTER (WHERE status = 'ready') AS ready, count(*) FILTER (WHERE status = 'insufficient') AS insufficient_history,
 count(*) FILTER (WHERE status = 'unavailable') AS data_unavailable,
 count(*) FILTER (WHERE status = 'reviewed_no_retry') AS reviewed_no_retry, CAST(sum(rolling_bars) AS BIGINT) AS rolling_rows FROM detail"""


@query("readiness_summary", with_ctes("bars eligible_members lifecycle history_ids", SUMMARY, detail=READINESS))
def readiness_summary(spark, folder):
    return W.readiness_summary(readiness_detail(spark, folder))


_ALIGNED = """SELECT b.security_id, b.date, b.close AS close_stock, k.close AS close_benchmark FROM bars b JOIN benchmark_bars k ON b.date = k.date"""


def _aligned(spark, folder):
    return W.common_calendar(fx.bars(spark, folder), fx.benchmark_bars(spark, folder))


@query("common_calendar", with_ctes("bars benchmark_bars", _ALIGNED))
def common_calendar(spark, folder):
    return _aligned(spark, folder).select("security_id", "date", "close_stock", "close_benchmark")


@query(
    "rs20",
    with_ctes(
        "bars benchmark_bars",
        """SELECT security_id, date, rs20, 'ok' AS outcome FROM (SELECT security_id, date,
 ((close_stock / lag(close_stock, 20) OVER w - 1) - (close_benchmark / lag(close_benchmark, 20) OVER w - 1)) * 100 AS rs20,
 row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS rn FROM aligned
 WINDOW w AS (PARTITION BY security_id ORDER BY date)) WHERE rn = 1""",
        aligned=_ALIGNED,
    ),
)
def rs20(spark, folder):
    return W.rs20(_aligned(spark, folder)).select("security_id", "date", "rs20", "outcome")


@query(
    "rs20_series",
    with_ctes(
        "bars benchmark_bars",
        """SELECT security_id, date, ((close_stock / lag(close_stock, 20) OVER w - 1)
 - (close_benchmark / lag(close_benchmark, 20) OVER w - 1)) * 100 AS rs20, row_number() OVER w AS shared_bars
 FROM aligned WINDOW w AS (PARTITION BY security_id ORDER BY date)""",
        aligned=_ALIGNED,
    ),
)
def rs20_series(spark, folder):
    return W.rs20_series(_aligned(spark, folder)).withColumn("shared_bars", F.col("shared_bars").cast("long"))


_GATE_BARS = f"""SELECT date, security_id, ticker, open, CASE WHEN suppkey % 10 = 6 AND n % 97 = 0 THEN low * 0.5 ELSE high END AS high, low, close,
 CASE WHEN suppkey % 10 = 7 AND n % 50 = 0 THEN 0.0 ELSE adj_close END AS adj_close, volume FROM keyed_bars"""


def _gate_bars(spark, folder):
    return fx.keyed_bars(spark, folder).select(
        "date", "security_id", "ticker", "open",
        F.expr("CASE WHEN suppkey % 10 = 6 AND n % 97 = 0 THEN low * 0.5D ELSE high END").alias("high"), "low", "close",
        F.expr("CASE WHEN suppkey % 10 = 7 AND n % 50 = 0 THEN 0.0D ELSE adj_close END").alias("adj_close"), "volume",
    )


@query(
    "history_gate",
    with_ctes(
        "keyed_bars benchmark_bars members_later",
        f"""SELECT m.security_id, m.ticker, CASE WHEN error IS NULL THEN 'passed' ELSE 'failed' END AS status, error,
 history_rows, first_date, last_date, shared_rows, factor_min, factor_max FROM members_later m JOIN
 (SELECT b.security_id, count(*) AS history_rows, min(b.date) AS first_date, max(b.date) AS last_date, count(k.date) AS shared_rows,
  min(adj_close / b.close) AS factor_min, max(adj_close / b.close) AS factor_max,
  CASE WHEN bool_or(b.ticker <> x.ticker) THEN 'identity_mismatch' WHEN bool_or(b.issues <> '') THEN 'qc_rejected' END AS error
  FROM (SELECT *, {qc_sql()} AS issues FROM gate_bars) b JOIN members_later x USING (security_id) LEFT JOIN (SELECT date FROM benchmark_bars) k ON b.date = k.date
  GROUP BY 1) g USING (security_id)""",
        gate_bars=_GATE_BARS,
    ),
)
def history_gate(spark, folder):
    expected = fx.members(spark, folder, later=True).select("security_id", "ticker")
    out = W.history_gate(_gate_bars(spark, folder), fx.benchmark_bars(spark, folder), expected)
    return out.select(
        "security_id", "ticker", "status", "error", "history_rows", "first_date", "last_date", "shared_rows",
        "factor_min", "factor_max",
    )


# --- continuity
@query(
    "terminal_summary",
    with_ctes(
        "event_bars",
        """SELECT as_of_date, as_of_security_count, terminal_date_min, terminal_date_max, terminal_date_histogram,
 CASE WHEN terminal_date_max > as_of_date THEN 'partial_leading_edge' ELSE 'coherent' END AS verdict
 FROM (SELECT arg_max(d, n * 100000 + date_diff('day', DATE '1990-01-01', d)) AS as_of_date, max(n) AS as_of_security_count,
  min(d) AS terminal_date_min, max(d) AS terminal_date_max,
  string_agg(CAST(d AS VARCHAR) || ':' || CAST(n AS VARCHAR), '|' ORDER BY d) AS terminal_date_histogram
  FROM (SELECT d, count(*) AS n FROM (SELECT security_id, max(date) AS d FROM event_bars GROUP BY 1) GROUP BY 1))""",
    ),
)
def terminal_summary(spark, folder):
    return C.terminal_summary(fx.event_bars(spark, folder))


PREVIOUS, CANDIDATE = date(2024, 1, 10), date(2024, 1, 29)
_SPAN = f"date > DATE '{PREVIOUS}' AND date <= DATE '{CANDIDATE}'"
GAPS = f"""SELECT i.security_id, s.date AS missing_session FROM
 (SELECT security_id FROM event_bars GROUP BY 1 HAVING max(date) >= DATE '{CANDIDATE}') i,
 (SELECT DISTINCT date FROM event_bars WHERE {_SPAN}) s
 WHERE NOT EXISTS (SELECT 1 FROM event_bars e WHERE e.security_id = i.security_id AND e.date = s.date)"""


@query("session_gaps", with_ctes("event_bars", GAPS))
def session_gaps(spark, folder):
    return C.session_gaps(fx.event_bars(spark, folder), PREVIOUS, CANDIDATE)


@query(
    "session_gap_summary",
    with_ctes(
        "event_bars",
        f"""SELECT count(DISTINCT security_id) AS gap_security_count, count(*) AS missing_bars,
 (SELECT count(DISTINCT date) FROM event_bars WHERE {_SPAN}) AS expected_sessions FROM gaps""",
        gaps=GAPS,
    ),
)
def session_gap_summary(spark, folder):
    return C.session_gap_summary(fx.event_bars(spark, folder), PREVIOUS, CANDIDATE)


@query("expected_sessions", with_ctes("event_bars", f"SELECT DISTINCT date FROM event_bars WHERE {_SPAN}"))
def expected_sessions(spark, folder):
    return C.expected_sessions(fx.event_bars(spark, folder), PREVIOUS, CANDIDATE)


@query(
    "session_availability",
    with_ctes(
        "raw_rows members",
        f"""SELECT security_id, CASE WHEN n = 1 AND issues = '' THEN 'valid' WHEN n IS NOT NULL THEN 'partial' ELSE 'missing' END AS availability
 FROM members LEFT JOIN (SELECT security_id, count(*) AS n, min({qc_sql()}) AS issues FROM raw_rows WHERE date = DATE '{SESSION}' GROUP BY 1) USING (security_id)""",
    ),
)
def session_availability(spark, folder):
    return N.session_availability(fx.members(spark, folder), N.select_session(fx.raw_rows(spark, folder), SESSION))


@query(
    "gap_evidence",
    with_ctes(
        "event_bars",
        """SELECT g.security_id, g.missing_session, s.close IS NOT NULL AS in_history, s.close, s.volume, h.n AS history_rows, h.d AS history_latest_date
 FROM gaps g LEFT JOIN source_rows s ON g.security_id = s.security_id AND g.missing_session = s.date
 LEFT JOIN (SELECT security_id, count(*) AS n, max(date) AS d FROM source_rows GROUP BY 1) h ON g.security_id = h.security_id""",
        busy="SELECT * FROM event_bars WHERE volume > 1",
        gaps=GAPS.replace("event_bars", "busy"),
        source_rows="SELECT * FROM event_bars",
    ),
)
def gap_evidence(spark, folder):
    source = fx.event_bars(spark, folder)
    gaps = C.session_gaps(source.filter(F.col("volume") > 1), PREVIOUS, CANDIDATE)
    return C.gap_evidence(gaps, source).select(
        "security_id", "missing_session", "in_history", "close", "volume", "history_rows", "history_latest_date"
    )


@query(
    "bracketed_gap",
    with_ctes(
        "bars",
        f"""SELECT security_id, arg_max(ticker, date) AS ticker FROM bars GROUP BY 1
 HAVING bool_or(date < DATE '{SESSION}') AND bool_or(date > DATE '{SESSION}') AND NOT bool_or(date = DATE '{SESSION}')""",
    ),
)
def bracketed_gap(spark, folder):
    return C.bracketed_gap(fx.bars(spark, folder), SESSION)


@query(
    "session_coverage",
    with_ctes(
        "bars eligible_members",
        f"""SELECT count(*) AS allowed, count(b.security_id) AS present, count(*) - count(b.security_id) AS absent, count(b.security_id) >= 15 AS enough
 FROM eligible_members m LEFT JOIN (SELECT security_id FROM bars WHERE date = DATE '{SESSION}') b USING (security_id)""",
    ),
)
def session_coverage(spark, folder):
    return C.session_coverage(fx.eligible_members(spark, folder), fx.bars(spark, folder), SESSION, 15)


# late enough for most of the lifecycle events
COVERAGE_DAY = date(2001, 9, 28)


@query(
    "session_coverage_allowed",
    with_ctes(
        "bars eligible_members lifecycle",
        f"""SELECT count(*) AS eligible, count(h.security_id) AS operational, count(h.security_id) FILTER (WHERE may) AS allowed,
 count(*) FILTER (WHERE may AND on_day) AS present, count(*) FILTER (WHERE may AND NOT on_day) AS absent
 FROM (SELECT m.security_id, NOT coalesce(lifecycle_status IN ('VERIFIED_TERMINATED_PUBLIC_LISTING', 'VERIFIED_NONTRADABLE_PRIMARY_EXCHANGE') AND effective_date <= DATE '{COVERAGE_DAY}', false) AS may
  FROM eligible_members m LEFT JOIN lifecycle USING (security_id)) m
 LEFT JOIN (SELECT security_id, bool_or(date = DATE '{COVERAGE_DAY}') AS on_day FROM bars GROUP BY 1) h USING (security_id)""",
    ),
)
def session_coverage_allowed(spark, folder):
    bars = fx.bars(spark, folder)
    return C.allowed_coverage(fx.eligible_members(spark, folder), fx.lifecycle(spark, folder), bars, COVERAGE_DAY)


@query(
    "ready_selection",
    with_ctes(
        "bars eligible_members lifecycle history_ids members_later",
        """SELECT NULL AS security_id, 'inconsistent_ready_ids' AS violation UNION ALL
 SELECT security_id, 'not_eligible' FROM detail WHERE status = 'ready'
  AND security_id NOT IN (SELECT security_id FROM members_later WHERE sharia_compliance = 'COMPLIANT')""",
        detail=READINESS,
    ),
)
def ready_selection(spark, folder):
    detail = readiness_detail(spark, folder)
    ready = detail.filter(F.col("status") == "ready")
    later = fx.members(spark, folder, later=True).filter(F.col("sharia_compliance") == "COMPLIANT")
    excluded = detail.filter(F.col("status").isin("insufficient", "unavailable"))
    # the declared count is wrong on purpose, the eligibility count is right
    return C.ready_selection(ready, later, excluded, -1, later.count())


@query(
    "ready_filter",
    with_ctes(
        "bars eligible_members lifecycle history_ids",
        f"""SELECT {BARS} FROM (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS rn FROM bars)
 WHERE rn <= {READY_TARGET} AND security_id IN (SELECT security_id FROM detail WHERE status = 'ready')""",
        detail=READINESS,
    ),
)
def ready_filter(spark, folder):
    rolling = W.rolling_tail(fx.bars(spark, folder), READY_TARGET)
    return C.ready_filter(rolling, readiness_detail(spark, folder).filter(F.col("status") == "ready"))


@query(
    "ready_filter_violations",
    with_ctes(
        "dirty_bars members",
        f"""SELECT m.security_id, coalesce(n, 0) AS rows, CASE WHEN n IS NULL THEN 'no_rolling_data'
 WHEN n < 519 OR n > 520 THEN 'row_count_outside_thresholds' ELSE 'qc_rejected' END AS violation
 FROM members m LEFT JOIN (SELECT security_id, count(*) AS n, count(*) FILTER (WHERE {qc_sql()} <> '') AS bad
  FROM (SELECT * FROM dirty_bars QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 520) GROUP BY 1) USING (security_id)
 WHERE n IS NULL OR n < 519 OR bad > 0""",
    ),
)
def ready_filter_violations(spark, folder):
    rolling = W.rolling_tail(fx.dirty_bars(spark, folder), 520)
    details = rolling.groupBy("security_id").agg(F.count("*").alias("rolling_bars"), F.max("date").alias("last_date"))
    return C.ready_filter_violations(rolling, fx.members(spark, folder), details, 519, 520)


# --- snapshot diffs: canonical and candidate are fixed-size windows of two days
CANONICAL_DAY, NEXT_DAY = date(2001, 10, 1), date(2001, 10, 2)
SCENARIOS = ("advance", "changed_value", "before_as_of", "identical", "fewer_securities")


def _snapshots(spark, folder):
    """Both windows, written once by security: several scenarios read them."""
    b = clustered(fx.bars(spark, folder).filter(F.col("date") <= NEXT_DAY), "bars")
    windows = {"canonical": CANONICAL_DAY, "candidate": NEXT_DAY}
    return [clustered(W.rolling_tail(b.filter(F.col("date") <= day)), name) for name, day in windows.items()]


def _snapshot_pair(spark, folder, scenario, held):
    canonical, candidate = held
    if scenario == "changed_value":
        hit = F.col("date") == date(2001, 9, 28)
        candidate = candidate.withColumn("close", F.when(hit, F.col("close") * 2).otherwise(F.col("close")))
    if scenario == "identical":
        candidate = canonical
    if scenario == "fewer_securities":
        candidate = canonical.join(fx.history_ids(spark, folder), "security_id", "left_semi")
    return canonical, candidate, CANONICAL_DAY if scenario == "before_as_of" else NEXT_DAY


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


_WIN = f"SELECT {BARS} FROM bars WHERE date <= DATE '%s' QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 300"
_CANON, _CAND = _WIN % CANONICAL_DAY, _WIN % NEXT_DAY
_MOVED = """SELECT (SELECT count(*) FROM canon c ANTI JOIN cand n ON c.security_id = n.security_id AND c.date = n.date) AS removed_rows,
 (SELECT count(*) FROM cand n ANTI JOIN canon c ON c.security_id = n.security_id AND c.date = n.date) AS added_rows,
 (SELECT count(DISTINCT n.security_id) FROM cand n ANTI JOIN canon c ON c.security_id = n.security_id AND c.date = n.date) AS affected_securities"""
_GONE = "SELECT count(*) AS n FROM (SELECT DISTINCT security_id FROM canon) WHERE security_id NOT IN (SELECT security_id FROM history_ids)"


@query(
    "window_advance_diff",
    with_ctes(
        "bars history_ids",
        """SELECT 'advance' AS scenario, true AS safe, 'pure_late_arrival_window_advance' AS reason, NULL AS detail, NULL AS changed_rows, removed_rows, added_rows, affected_securities FROM moved
 UNION ALL SELECT 'changed_value', false, 'overlap_values_changed', 'close', (SELECT count(*) FROM canon JOIN cand USING (security_id, date) WHERE date = DATE '2001-09-28'), removed_rows, added_rows, affected_securities FROM moved
 UNION ALL SELECT 'before_as_of', false, 'added_after_as_of', NULL, NULL, removed_rows, added_rows, affected_securities FROM moved
 UNION ALL SELECT 'identical', false, 'not_balanced_window_shift', NULL, NULL, 0, 0, 0
 UNION ALL SELECT 'fewer_securities', false, 'security_set_changed', NULL, NULL, (SELECT count(*) FROM canon WHERE security_id NOT IN (SELECT security_id FROM history_ids)), 0, 0""",
        canon=_CANON, cand=_CAND, moved=_MOVED,
    ),
)
def window_advance_diff(spark, folder):
    frames = []
    held = _snapshots(spark, folder)
    for name in SCENARIOS:
        canonical, candidate, as_of = _snapshot_pair(spark, folder, name, held)
        frames.append(S.window_advance_diff(canonical, candidate, as_of).withColumn("scenario", F.lit(name)))
    return _union(frames)


@query(
    "set_reduction_diff",
    with_ctes(
        "bars history_ids",
        """SELECT 'advance' AS scenario, false AS safe, 'not_security_set_reduction' AS reason, CAST(0 AS BIGINT) AS removed_securities
 UNION ALL SELECT 'identical', false, 'not_security_set_reduction', 0
 UNION ALL SELECT 'fewer_securities', true, 'pure_security_set_reduction', n FROM gone""",
        canon=_CANON, gone=_GONE,
    ),
)
def set_reduction_diff(spark, folder):
    frames = []
    held = _snapshots(spark, folder)
    for name in ("advance", "identical", "fewer_securities"):
        canonical, candidate, _ = _snapshot_pair(spark, folder, name, held)
        frames.append(S.set_reduction_diff(canonical, candidate).withColumn("scenario", F.lit(name)))
    return _union(frames).select("scenario", "safe", "reason", "removed_securities")


@query(
    "window_advance_details",
    with_ctes(
        "bars",
        """SELECT security_id, coalesce(string_agg(CASE WHEN side = 'r' THEN CAST(date AS VARCHAR) END, '|' ORDER BY date), '') AS removed_dates,
 coalesce(string_agg(CASE WHEN side = 'a' THEN CAST(date AS VARCHAR) END, '|' ORDER BY date), '') AS added_dates
 FROM (SELECT c.security_id, c.date, 'r' AS side FROM canon c ANTI JOIN cand n ON c.security_id = n.security_id AND c.date = n.date
  UNION ALL SELECT n.security_id, n.date, 'a' FROM cand n ANTI JOIN canon c ON c.security_id = n.security_id AND c.date = n.date) GROUP BY 1""",
        canon=_CANON, cand=_CAND,
    ),
)
def window_advance_details(spark, folder):
    canonical, candidate, _ = _snapshot_pair(spark, folder, "advance", _snapshots(spark, folder))
    return S.window_advance_details(canonical, candidate)


# --- reconciliation
_CMP = f"""SELECT a.security_id AS aid, coalesce(a.security_id, b.security_id) AS security_id, coalesce(a.date, b.date) AS date,
 a.open AS ao, b.open AS bo, a.high AS ah, b.high AS bh, a.low AS al, b.low AS bl, a.close AS ac, b.close AS bc,
 CAST(a.volume AS DOUBLE) AS av, CAST(b.volume AS DOUBLE) AS bv, a.adj_close AS aa, b.adj_close AS ba, b.issues AS b_issues
 FROM provider_a a FULL JOIN (SELECT *, {qc_sql(SHORT)} AS issues FROM provider_b) b ON a.security_id = b.security_id AND a.date = b.date"""
_CLASS = """CASE WHEN aid IS NOT NULL AND b_issues = '' THEN 'common' WHEN aid IS NOT NULL AND b_issues IS NOT NULL THEN 'only_in_a_b_invalid'
 WHEN aid IS NOT NULL THEN 'only_in_a' WHEN b_issues = '' THEN 'only_in_b' ELSE 'b_invalid' END"""


_DELTAS = ", ".join(
    f"CASE WHEN row_class = 'common' THEN a{s} - b{s} END AS {c}_delta,"
    f" CASE WHEN row_class = 'common' AND b{s} <> 0 THEN (a{s} - b{s}) / b{s} END AS {c}_relative"
    for c, s in zip(("open", "high", "low", "close", "volume"), "ohlcv")
)


@query(
    "provider_compare",
    with_ctes(
        "provider_a provider_b",
        f"""SELECT security_id, date, row_class, {_DELTAS},
 CASE WHEN row_class = 'common' THEN aa - ba END AS adj_close_delta, b_issues FROM (SELECT *, {_CLASS} AS row_class FROM cmp)""",
        cmp=_CMP,
    ),
)
def provider_compare(spark, folder):
    return R.provider_compare(fx.provider_a(spark, folder), fx.provider_b(spark, folder))


@query(
    "provider_compare_summary",
    with_ctes(
        "provider_a provider_b",
        f"""SELECT security_id, count(*) FILTER (WHERE k = 'common') AS common_dates,
 count(*) FILTER (WHERE k IN ('only_in_a', 'only_in_a_b_invalid')) AS dates_only_in_a, count(*) FILTER (WHERE k = 'only_in_b') AS dates_only_in_b,
 count(*) FILTER (WHERE k IN ('b_invalid', 'only_in_a_b_invalid')) AS b_invalid_dates, max(date) FILTER (WHERE aid IS NOT NULL) AS a_latest_date,
 max(date) FILTER (WHERE b_issues = '') AS b_latest_valid_date, max(date) FILTER (WHERE b_issues IS NOT NULL) AS b_latest_observed_date
 FROM (SELECT *, {_CLASS} AS k FROM cmp) GROUP BY 1""",
        cmp=_CMP,
    ),
)
def provider_compare_summary(spark, folder):
    return R.provider_compare_summary(R.provider_compare(fx.provider_a(spark, folder), fx.provider_b(spark, folder)))


@query(
    "parity_metrics",
    with_ctes(
        "provider_a provider_b",
        """SELECT count(*) AS overlap_rows, quantile_cont(err, 0.5) AS median_abs_pct_error, quantile_cont(err, 0.95) AS p95_abs_pct_error,
 max(err) AS max_abs_pct_error FROM (SELECT abs(b.adj_close - a.adj_close) / abs(a.adj_close) AS err
 FROM provider_a a JOIN provider_b b ON a.ticker = b.ticker AND a.date = b.date WHERE abs(a.adj_close) > 0)""",
    ),
)
def parity_metrics(spark, folder):
    return R.parity_metrics(fx.provider_a(spark, folder), fx.provider_b(spark, folder))


_KIND = """SELECT a.security_id, a.date, a.volume - b.volume AS volume_diff,
 CASE WHEN NOT same THEN 'price_diff' WHEN a.volume = b.volume THEN 'exact' ELSE 'volume_only' END AS kind
 FROM (SELECT * FROM provider_a) a JOIN (SELECT * FROM provider_b) b ON a.security_id = b.security_id AND a.date = b.date,
 LATERAL (SELECT abs(a.open - b.open) < 1e-8 AND abs(a.high - b.high) < 1e-8 AND abs(a.low - b.low) < 1e-8
  AND abs(a.close - b.close) < 1e-8 AND abs(a.adj_close - b.adj_close) < 1e-8 AS same)"""


@query("evidence_kind", with_ctes("provider_a provider_b", _KIND))
def evidence_kind(spark, folder):
    return R.evidence_kind(fx.provider_a(spark, folder), fx.provider_b(spark, folder))


@query("evidence_summary", with_ctes("provider_a provider_b", "SELECT kind, count(*) AS bars FROM kinds GROUP BY 1", kinds=_KIND))
def evidence_summary(spark, folder):
    return R.evidence_summary(R.evidence_kind(fx.provider_a(spark, folder), fx.provider_b(spark, folder)))


@query(
    "bar_coverage",
    with_ctes(
        "dirty_bars",
        """SELECT security_id, count(*) AS rows, count(*) FILTER (WHERE ok) AS adjusted_close_rows, min(date) FILTER (WHERE ok) AS first_date,
 max(date) FILTER (WHERE ok) AS last_date, count(*) FILTER (WHERE ok) >= 252 AS has_252_adjusted_close_bars
 FROM (SELECT *, coalesce(NOT isnan(adj_close) AND adj_close > 0, false) AS ok FROM dirty_bars) GROUP BY 1""",
    ),
)
def bar_coverage(spark, folder):
    return R.bar_coverage(fx.dirty_bars(spark, folder))


@query(
    "coverage_fraction",
    with_ctes(
        "bars",
        """SELECT count(*) AS securities, count(*) FILTER (WHERE n >= 252) AS covered, count(*) FILTER (WHERE n >= 252) / count(*) AS coverage_fraction
 FROM (SELECT security_id, count(*) FILTER (WHERE adj_close > 0) AS n FROM bars GROUP BY 1)""",
    ),
)
def coverage_fraction(spark, folder):
    return R.coverage_fraction(R.bar_coverage(fx.bars(spark, folder)))


def _offers(spark, folder):
    first, second = fx.provider_a(spark, folder), fx.provider_b(spark, folder)
    tag = lambda df, p, n: df.withColumns({"provider": F.lit(p), "priority": F.lit(n)})
    return tag(first, "FIRST", 1).unionByName(tag(second, "SECOND", 2))


@query(
    "provider_fallback",
    with_ctes(
        "provider_a provider_b members",
        """SELECT m.security_id, CASE WHEN coalesce(a.n, 0) >= 252 THEN 'FIRST' WHEN coalesce(b.n, 0) >= 252 THEN 'SECOND' ELSE 'UNRESOLVED' END AS selected_provider,
 CASE WHEN coalesce(a.n, 0) >= 252 THEN a.n WHEN coalesce(b.n, 0) >= 252 THEN b.n ELSE 0 END AS adjusted_close_rows
 FROM members m LEFT JOIN (SELECT security_id, count(*) AS n FROM provider_a WHERE adj_close > 0 GROUP BY 1) a USING (security_id)
 LEFT JOIN (SELECT security_id, count(*) AS n FROM provider_b WHERE adj_close > 0 GROUP BY 1) b USING (security_id)""",
    ),
)
def provider_fallback(spark, folder):
    return R.provider_fallback(fx.members(spark, folder), _offers(spark, folder))
