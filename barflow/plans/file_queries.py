"""Queries that land files derived from the tables, read them back, publish or stream them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barflow.operators import ema as E
from barflow.operators import normalize as N
from barflow.operators import tails as TL
from barflow.operators import windows as W
from barflow.plans import bar_queries as B
from barflow.plans import ema_queries as Q
from barflow.plans import fixtures as fx
from barflow.plans import jobs
from barflow.plans.catalog import query
from barflow.plans.fixtures import with_ctes
from barflow.schemas import BAR_COLUMNS, BARS, EMA_STATE_COLUMNS, PRICES, ContractError
from barflow.session import clustered, many_small_files, materialize, new_folder
from barflow.sinks import digests as D
from barflow.sinks import publish as P
from barflow.sinks import repair as RP
from barflow.sinks import writers as S
from barflow.sources import readers as R
from barflow.streaming import streams as T

NAMES = ", ".join(BAR_COLUMNS)


@query("read_bars", with_ctes("bars", f"SELECT {NAMES} FROM bars"))
def read_bars(spark, folder):
    path = new_folder(spark, "bars")
    S.write_bars(fx.bars(spark, folder), path)
    return R.read_bars(spark, path)


@query("write_bars", with_ctes("bars", "SELECT security_id, count(*) AS bars, min(date) AS first_date, max(date) AS last_date FROM bars GROUP BY 1"))
def write_bars(spark, folder):
    written = S.write_bars(fx.bars(spark, folder), new_folder(spark, "bars"))
    return written.groupBy("security_id").agg(
        F.count("*").alias("bars"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query(
    "upsert_daily",
    with_ctes(
        "event_bars",
        f"""SELECT date, security_id, ticker, open, high, low, close, adj_close,
 CASE WHEN date >= DATE '2024-01-18' THEN volume + 1 ELSE volume END AS volume FROM event_bars""",
    ),
)
def upsert_daily(spark, folder):
    path = new_folder(spark, "daily")
    bars = fx.event_bars(spark, folder)
    S.upsert_daily(spark, path, bars.filter(F.col("date") <= date(2024, 1, 20)), "volume")
    newer = bars.filter(F.col("date") >= date(2024, 1, 18))
    S.upsert_daily(spark, path, newer.withColumn("volume", F.col("volume") + 1), "volume")
    return R.read_bars(spark, path)


@query("write_issue_csv", with_ctes("dirty_bars", f"SELECT security_id, CAST(date AS VARCHAR) AS date, issues FROM (SELECT *, {B.qc_sql()} AS issues FROM dirty_bars) WHERE issues <> ''"))
def write_issue_csv(spark, folder):
    path = new_folder(spark, "issues")
    S.write_issue_csv(N.qc_bad_bars(fx.dirty_bars(spark, folder)).select("security_id", "date", "issues"), path)
    return spark.read.option("header", "true").csv(path)


@query("read_membership", with_ctes("eligible_members", "SELECT '2001-08-28' AS snapshot_date, security_id, ticker, name, exchange, sharia_compliance FROM eligible_members"))
def read_membership(spark, folder):
    path = new_folder(spark, "membership")
    record = F.struct("security_id", "ticker", "name", "exchange", "sharia_compliance")
    # documents of at most a thousand members each
    docs = (
        fx.members(spark, folder)
        .groupBy((F.col("suppkey") / 1000).cast("long").alias("doc"))
        .agg(F.collect_list(record).alias("records"))
        .select(
            F.to_json(
                F.struct(F.lit("2001-08-28").alias("snapshot_date"), F.size("records").alias("count"), "records")
            ).alias("value")
        )
    )
    docs.write.text(path)
    return R.read_membership(spark, path, "2001-08-28", multi_line=False)


@query(
    "read_symbol_directory",
    """SELECT 'P' || CAST(p_partkey AS VARCHAR) AS symbol, p_name AS security_name, 'NASDAQ' AS listing_exchange, p_type AS market_category, 'N' AS financial_status,
 CASE WHEN p_size < 5 THEN 'Y' ELSE 'N' END AS is_etf, 'N' AS test_issue, 'nasdaqlisted.txt' AS source_file FROM part
 UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, 'N', NULL, NULL, 'N', CASE WHEN s_acctbal < 0 THEN 'Y' ELSE 'N' END, 'otherlisted.txt' FROM supplier""",
)
def read_symbol_directory(spark, folder):
    base = new_folder(spark, "directory")
    trailer = F.lit("File Creation Time: 0828200121:31")

    def land(df, name):
        end = spark.range(1).select(trailer.alias(df.columns[0]))
        df.unionByName(end, allowMissingColumns=True).write.option("sep", "|").option("header", "true").csv(
            f"{base}/{name}"
        )
        return f"{base}/{name}"

    p, s = fx.table(spark, folder, "part"), fx.table(spark, folder, "supplier")
    listed = p.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("Symbol"),
        F.col("p_name").alias("Security Name"), F.col("p_type").alias("Market Category"),
        F.lit("N").alias("Test Issue"), F.lit("N").alias("Financial Status"), F.lit("100").alias("Round Lot Size"),
        F.when(F.col("p_size") < 5, "Y").otherwise("N").alias("ETF"), F.lit("N").alias("NextShares"),
    )
    other = s.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ACT Symbol"),
        F.col("s_name").alias("Security Name"), F.lit("N").alias("Exchange"),
        F.lit("N").alias("ETF"), F.when(F.col("s_acctbal") < 0, "Y").otherwise("N").alias("Test Issue"),
    )
    out = R.read_symbol_directory(
        spark, land(listed, "nasdaqlisted.txt"), land(other, "otherlisted.txt"), "2001-08-28T22:00:00Z", "v1"
    )
    return out.drop("source_provider", "source_contract_version", "fetched_at")


@query(
    "read_bulk_archive",
    with_ctes(
        "dirty_bars",
        f"""SELECT security_id, CASE WHEN bool_or(close IS NULL) THEN 'null_or_non_numeric' WHEN bool_or({B.qc_sql(B.SHORT)} <> '') THEN 'qc_rejected' ELSE 'staged' END AS verdict,
 count(*) AS bars, max(date) AS last_date FROM dirty_bars GROUP BY 1""",
    ),
)
def read_bulk_archive(spark, folder):
    path = new_folder(spark, "archive")
    rows = fx.dirty_bars(spark, folder)
    number = lambda c: F.col(c).cast("string")
    landed = rows.select(
        F.col("ticker").alias("dir"),
        F.concat("ticker", F.lit(".US")).alias("<TICKER>"), F.lit("D").alias("<PER>"),
        F.date_format("date", "yyyyMMdd").alias("<DATE>"), F.lit("000000").alias("<TIME>"),
        number("open").alias("<OPEN>"), number("high").alias("<HIGH>"), number("low").alias("<LOW>"),
        number("close").alias("<CLOSE>"), number("volume").alias("<VOL>"), F.lit("0").alias("<OPENINT>"),
    )
    # tasks move their own files into place: one mover for all would take as long as they are many
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a file takes longer than its bytes do, so tasks are not joined by their bytes
    out = landed.repartition(tasks, "dir").write.partitionBy("dir").option("header", "true")
    out.option("mapreduce.fileoutputcommitter.algorithm.version", "2").csv(path)
    # the manifest names the file that holds each security, from the listing of the files
    with many_small_files(spark):
        files = spark.read.format("binaryFile").load(path)
        found = files.select(F.col("dir").alias("ticker"), R.file_label(2).alias("filename")).distinct()
        manifest = (
            fx.members(spark, folder)
            .select("security_id", "ticker")
            .join(found, "ticker")
            .withColumn("status", F.lit("copied"))
        )
        manifest = materialize(manifest, "manifest")
    out = R.read_bulk_archive(spark, path, manifest, path_parts=2)
    return out.groupBy("security_id", "verdict").agg(F.count("*").alias("bars"), F.max("date").alias("last_date"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "unpivot_provider",
    """SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
 max(o_totalprice) AS close, max(o_totalprice) / 2 AS adj_close, CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1, 2""",
)
def unpivot_provider(spark, folder):
    price = F.col("o_totalprice")
    wide = (
        fx.table(spark, folder, "orders")
        .groupBy(fx.day_of("o_orderdate").alias("Date"))
        .pivot("o_orderpriority", PRIORITIES)
        .agg(
            F.min(price).alias("Open"), F.max(price).alias("High"), F.min(price).alias("Low"),
            F.max(price).alias("Close"), (F.max(price) / 2).alias("Adj Close"),
            F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double").alias("Volume"),
        )
    )
    names = {f"{p}_{f}": f"{p}|{f}" for p in PRIORITIES for f in R.PROVIDER_NAMES}
    return R.unpivot_provider(wide.withColumnsRenamed(names))


def _payload(layout: str):
    text = lambda c: F.col(c).cast("string")
    day = F.concat(F.col("date").cast("string"), F.lit("T00:00:00"))
    if layout == "map":
        return F.struct(day.alias("t"), *[text(c).alias(a) for c, a in zip(("open", "high", "low", "close", "volume"), "ohlcv")])
    names = [text(c).alias(c) for c in ("open", "high", "low", "close", "volume")]
    if layout == "values":
        return F.struct(day.alias("datetime"), *names)
    return F.struct(day.alias("date"), *names, text("adj_close").alias("adjClose"))


def _landed(spark, folder, layout):
    """One payload per security; some are errors, foreign, repeated or hold a bad bar."""
    k = fx.keyed_bars(spark, folder).withColumn(
        "high", F.expr("CASE WHEN suppkey % 10 = 3 AND n % 97 = 0 THEN low * 0.5D ELSE high END")
    )
    rows = k.groupBy("suppkey", "ticker").agg(F.sort_array(F.collect_list(_payload(layout))).alias("bars"))
    bars = F.when(F.col("suppkey") % 10 == 4, F.concat("bars", "bars")).otherwise(F.col("bars"))
    symbol = F.col("ticker")
    error = F.col("suppkey") % 10 == 2
    if layout == "values":
        name = F.when(F.col("suppkey") % 10 == 1, "OTHER").otherwise(F.lower("ticker"))
        doc = F.to_json(F.struct(F.lit("ok").alias("status"), F.struct(name.alias("symbol")).alias("meta"), bars.alias("values")))
        failed = F.lit('{"status": "error", "code": "429"}')
    elif layout == "list":
        doc, failed = F.to_json(bars), F.lit('{"detail": "not entitled"}')
    else:
        doc, failed = F.to_json(F.struct(F.create_map(symbol, bars).alias("bars"))), None
    payload = doc if failed is None else F.when(error, failed).otherwise(doc)
    return rows.select(symbol.alias("symbol"), payload.alias("payload"))


def _json_sql(layout: str) -> str:
    alien = "WHEN suppkey % 10 = 1 THEN 'identity_mismatch'" if layout == "values" else ""
    failed = "" if layout == "map" else "WHEN suppkey % 10 = 2 THEN 'response_error'"
    drop = "false" if layout == "map" else "verdict = 'response_error'"
    adj = "adj_close" if layout == "list" else "CAST(NULL AS DOUBLE)"
    body = f"""SELECT symbol, verdict, CASE WHEN {drop} THEN 1 ELSE count(*) END AS rows, CASE WHEN {drop} THEN NULL ELSE max(date) END AS last_date,
 CASE WHEN {drop} THEN NULL ELSE max(close) END AS top_close, CASE WHEN {drop} THEN NULL ELSE max(adj) END AS top_adj FROM
 (SELECT ticker AS symbol, date, close, {adj} AS adj, CASE {failed} {alien} WHEN suppkey % 10 = 3 AND bool_or(n % 97 = 0) OVER (PARTITION BY suppkey) THEN 'qc_rejected'
   WHEN suppkey % 10 = 4 THEN 'duplicate_dates' ELSE 'accepted' END AS verdict FROM keyed_bars) GROUP BY 1, 2"""
    return with_ctes("keyed_bars", body)


def _json_query(name: str, layout: str) -> None:
    @query(name, _json_sql(layout))
    def run(spark, folder):
        out = R.parse_provider_json(_landed(spark, folder, layout), layout)
        return out.groupBy("symbol", "verdict").agg(
            F.count("*").alias("rows"), F.max("date").alias("last_date"), F.max("close").alias("top_close"),
            F.max("adj_close").alias("top_adj"),
        )


_json_query("parse_provider_json", "values")
_json_query("parse_provider_json_list", "list")
_json_query("parse_provider_json_map", "map")


# --- publication
DAY_ONE, DAY_TWO, DAY_ZERO = date(2024, 1, 20), date(2024, 1, 21), date(2024, 1, 19)


def _window(spark, folder, day):
    bars = fx.event_bars(spark, folder).filter(F.col("date") <= day)
    return W.rolling_tail(bars, 15)


_SNAP = "SELECT * FROM event_bars WHERE date <= DATE '%s' QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 15"
_SIZES = "(SELECT count(*) FROM {0}), (SELECT count(DISTINCT security_id) FROM {0})"


@query(
    "publish_snapshot",
    with_ctes(
        "event_bars",
        f"""SELECT * FROM (SELECT 'first' AS step, 'CREATE' AS decision, CAST(1 AS BIGINT) AS seq, a AS rows, b AS securities FROM (SELECT {_SIZES.format('one')}) t(a, b)
 UNION ALL SELECT 'same', 'REUSE', 1, a, b FROM (SELECT {_SIZES.format('one')}) t(a, b)
 UNION ALL SELECT 'changed', 'REJECTED', 1, a, b FROM (SELECT {_SIZES.format('one')}) t(a, b)
 UNION ALL SELECT 'older', 'REJECTED', 1, a, b FROM (SELECT {_SIZES.format('one')}) t(a, b)
 UNION ALL SELECT 'next', 'CREATE', 2, a, b FROM (SELECT {_SIZES.format('two')}) t(a, b))""",
        one=_SNAP % DAY_ONE,
        two=_SNAP % DAY_TWO,
    ),
)
def publish_snapshot(spark, folder):
    root = new_folder(spark, "ready")
    one = _window(spark, folder, DAY_ONE)
    changed = one.withColumn("close", F.col("close") + 1)
    steps = [
        ("first", one, DAY_ONE),
        ("same", one.repartition(3, "date"), DAY_ONE),
        ("changed", changed, DAY_ONE),
        ("older", _window(spark, folder, DAY_ZERO), DAY_ZERO),
        ("next", _window(spark, folder, DAY_TWO), DAY_TWO),
    ]
    rows = []
    for step, frame, day in steps:
        try:
            decision = P.publish_snapshot(spark, frame, root, day).decision
        except ContractError:
            decision = "REJECTED"
        p = P.read_pointer(spark, root)
        rows.append((step, decision, p.seq, p.rows, p.securities))
    return spark.createDataFrame(rows, "step string, decision string, seq long, rows long, securities long")


@query("load_snapshot", with_ctes("event_bars", f"SELECT {NAMES} FROM one", one=_SNAP % DAY_ONE))
def load_snapshot(spark, folder):
    root = new_folder(spark, "ready")
    P.publish_snapshot(spark, _window(spark, folder, DAY_ONE), root, DAY_ONE)
    return P.load_snapshot(spark, root)[0].select(*BAR_COLUMNS)


@query(
    "fingerprint",
    with_ctes(
        "bars",
        """SELECT v AS variant, CASE WHEN v = 'repeated' THEN (SELECT count(*) FROM bars) + (SELECT count(*) FROM bars WHERE date = (SELECT min(date) FROM bars))
 ELSE (SELECT count(*) FROM bars) END AS rows, v IN ('plain', 'reordered') AS same_as_plain FROM unnest(['plain', 'reordered', 'changed', 'repeated']) AS t(v)""",
    ),
)
def fingerprint(spark, folder):
    """Do the bars as they are, reordered, changed and repeated share one fingerprint?"""
    bars = materialize(fx.bars(spark, folder), "bars")
    first = bars.agg(F.min("date")).scalar()
    variants = {
        "plain": bars,
        "reordered": bars.repartition("date").sortWithinPartitions("volume"),
        "changed": bars.withColumn("close", F.when(F.col("date") == first, F.col("close") + 1).otherwise(F.col("close"))),
        "repeated": bars.unionByName(bars.filter(F.col("date") == first)),
    }
    frames = [P.fingerprint_frame(df, BAR_COLUMNS).withColumn("variant", F.lit(name)) for name, df in variants.items()]
    # one row a variant: every variant is hashed once, the plain one too
    prints = materialize(B._union(frames), "prints")
    plain = prints.filter(F.col("variant") == "plain").select("fingerprint").scalar()
    return prints.select("variant", "rows", (F.col("fingerprint") == plain).alias("same_as_plain"))


# --- snapshots with a tree of digests
_SNAPSHOT_LAST = "security_id = (SELECT max(security_id) FROM bars)"


def _digested(spark, folder):
    """Two stored snapshots: the candidate lacks a day, has a new security and one changed volume and close."""
    bars = materialize(fx.bars(spark, folder), "bars")
    last = bars.agg(F.max("security_id").alias("s")).first().s
    day = F.col("date")
    candidate = bars.filter(day != F.lit(date(1999, 3, 3))).withColumns(
        {
            "volume": F.when((F.col("security_id") == last) & (F.dayofyear(day) == 200), F.col("volume") + 1).otherwise(F.col("volume")),
            "close": F.when((F.col("security_id") == last) & (F.dayofyear(day) == 200), F.col("close") + 1).otherwise(F.col("close")),
        }
    )
    new = bars.filter((F.col("security_id") == last) & (F.year(day) == 2000)).withColumn("security_id", F.lit("new"))
    one, other = new_folder(spark, "canonical"), new_folder(spark, "candidate")
    D.write_digested(bars, one, 16)
    D.write_digested(candidate.unionByName(new), other, 16)
    return one, other


@query(
    "snapshot_changed_bars",
    with_ctes(
        "bars",
        f"""SELECT security_id, date, 'removed' AS change, CAST(NULL AS VARCHAR) AS fields FROM bars WHERE date = DATE '1999-03-03'
 UNION ALL SELECT security_id, date, 'changed', 'close|volume' FROM bars WHERE {_SNAPSHOT_LAST} AND dayofyear(date) = 200 AND date <> DATE '1999-03-03'
 UNION ALL SELECT 'new', date, 'added', NULL FROM bars WHERE {_SNAPSHOT_LAST} AND year(date) = 2000""",
    ),
)
def snapshot_changed_bars(spark, folder):
    """What differs between two snapshots, read from unequal leaves only."""
    return D.changed_bars(spark, *_digested(spark, folder))


@query("snapshot_load_years", with_ctes("bars", f"SELECT {NAMES} FROM bars WHERE year(date) IN (1997, 1999)"))
def snapshot_load_years(spark, folder):
    """Two years of a snapshot, after a check of their leaves alone."""
    path = new_folder(spark, "digested")
    D.write_digested(fx.bars(spark, folder), path, 16)
    return D.load_digested(spark, path, [1997, 1999], parts=16)


# --- jobs
def _provider_rows(keyed):
    batch = fx.raw_of(keyed).filter(F.col("date") >= B.OVERLAP_DAY)
    single = fx.dirtied(keyed).filter(F.col("date") >= B.OVERLAP_DAY).withColumn("src_ord", F.lit(0))
    return batch, single


def _update(spark, folder, incremental=False):
    keyed = clustered(fx.keyed_bars(spark, folder), "keyed")
    batch, single = _provider_rows(keyed)
    history = B.history_of(keyed.select(*BAR_COLUMNS))
    return jobs.daily_update(
        fx.eligible_members(spark, folder), history, batch, single,
        fx.lifecycle(spark, folder), date(2001, 10, 31), 540, 500, _stored_window(history) if incremental else None,
    )


def _stored_window(history):
    """The window and counts that an earlier update left."""
    return clustered(W.rolling_tail(history, 540), "tail"), materialize(TL.bar_counts(history), "counts")


_RAW_NEW = B._RAW_COMPLETE.replace("FROM raw_rows", f"FROM (SELECT * FROM raw_rows WHERE date >= DATE '{B.OVERLAP_DAY}')")
_UPDATE_CTES = dict(
    hist=B._HIST,
    complete=_RAW_NEW,
    deduped=B._RAW_LAST,
    batch="SELECT security_id, max(CASE WHEN verdict = 'accepted' THEN 1 ELSE 0 END) AS ok FROM (" + B._NORMAL + ") GROUP BY 1",
    # single rows keep a security when every complete bar is sound
    single_rows=f"SELECT {NAMES} FROM dirty_bars WHERE date >= DATE '{B.OVERLAP_DAY}' AND close IS NOT NULL",
    single_ok=f"SELECT security_id FROM single_rows GROUP BY 1 HAVING NOT bool_or({B.qc_sql()} <> '')",
    allowed="""SELECT security_id FROM eligible_members LEFT JOIN lifecycle USING (security_id)
 WHERE NOT coalesce(lifecycle_status IN ('VERIFIED_TERMINATED_PUBLIC_LISTING', 'VERIFIED_NONTRADABLE_PRIMARY_EXCHANGE') AND effective_date <= DATE '2001-10-31', false)""",
    fetched=f"""SELECT {NAMES} FROM (SELECT {NAMES} FROM deduped WHERE security_id IN (SELECT security_id FROM batch WHERE ok = 1)
 UNION ALL SELECT {NAMES} FROM single_rows WHERE security_id IN (SELECT security_id FROM single_ok) AND security_id NOT IN (SELECT security_id FROM batch WHERE ok = 1))
 WHERE date <= DATE '2001-10-31' AND security_id IN (SELECT security_id FROM allowed)""",
    merged=f"""SELECT {NAMES} FROM hist UNION ALL SELECT f.* FROM fetched f ANTI JOIN hist h ON f.security_id = h.security_id AND f.date = h.date""",
)


_UPDATE_SQL = with_ctes(
    "bars raw_rows dirty_bars eligible_members lifecycle",
    """SELECT m.security_id, m.ticker, coalesce(b.n, 0) AS available_bars, CASE WHEN b.n IS NULL THEN 0 ELSE least(b.n, 540) END AS rolling_bars, b.d AS last_date,
 CASE WHEN b.n >= 500 THEN 'ready' ELSE 'insufficient' END AS status,
 CASE WHEN m.security_id NOT IN (SELECT security_id FROM allowed) THEN 'lifecycle_excluded'
  WHEN m.security_id NOT IN (SELECT security_id FROM batch WHERE ok = 1) AND m.security_id NOT IN (SELECT security_id FROM single_ok) THEN 'stale_after_failure' ELSE 'updated' END AS update_status
 FROM eligible_members m LEFT JOIN (SELECT security_id, count(*) AS n, max(date) AS d FROM merged GROUP BY 1) b USING (security_id)""",
    **_UPDATE_CTES,
)


@query("daily_update", _UPDATE_SQL)
def daily_update(spark, folder):
    return _update_facts(_update(spark, folder))


@query("daily_update_incremental", _UPDATE_SQL)
def daily_update_incremental(spark, folder):
    """The same facts from the stored window and counts."""
    return _update_facts(_update(spark, folder, incremental=True))


def _update_facts(u):
    return u.readiness.join(u.update_status, "security_id", "left").drop("first_rolling_date")


_ROLLING_SQL = with_ctes(
    "bars raw_rows dirty_bars eligible_members lifecycle",
    f"""SELECT r.security_id, r.date, coalesce(l.successor_ticker, m.ticker) AS ticker, r.open, r.high, r.low, r.close, r.adj_close, r.volume
 FROM (SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= 540) r
 JOIN eligible_members m ON m.security_id = r.security_id
 LEFT JOIN (SELECT * FROM lifecycle WHERE lifecycle_status = 'VERIFIED_TICKER_CHANGE_SAME_SECURITY' AND effective_date <= DATE '2001-10-31' AND trim(successor_ticker) <> '') l
 ON l.security_id = r.security_id WHERE r.security_id IN (SELECT security_id FROM hist)""",
    **_UPDATE_CTES,
)


@query("daily_update_rolling", _ROLLING_SQL)
def daily_update_rolling(spark, folder):
    return _update(spark, folder).rolling


@query("daily_update_rolling_incremental", _ROLLING_SQL)
def daily_update_rolling_incremental(spark, folder):
    return _update(spark, folder, incremental=True).rolling


@query(
    "ready_publication",
    with_ctes(
        "event_bars",
        """SELECT security_id, date, ticker, open + 1 AS open, high + 1 AS high, low + 1 AS low, close + 1 AS close, adj_close + 1 AS adj_close, volume,
 'CREATE' AS decision, CAST(DATE '2024-01-20' AS VARCHAR) AS as_of_date
 FROM one WHERE security_id IN (SELECT security_id FROM one GROUP BY 1 HAVING count(*) >= 14)""",
        one=_SNAP % DAY_ONE,
    ),
)
def ready_publication(spark, folder):
    root = new_folder(spark, "ready")
    # event values may be zero, which is no price
    rolling = _window(spark, folder, DAY_ONE).withColumns({c: F.col(c) + 1 for c in PRICES})
    members = rolling.select("security_id", "ticker").distinct()
    readiness = W.readiness(members, rolling, None, 15, 14)
    listed, held = readiness.filter("status = 'ready'").count(), members.count()
    done = jobs.ready_job(spark, rolling, readiness, members, listed, held, _no_quarantine(spark), root, DAY_ONE, 14, 15)
    published = P.load_snapshot(spark, root)[0]
    return published.withColumns({"decision": F.lit(done.decision), "as_of_date": F.lit(done.pointer.as_of_date)})


def _no_quarantine(spark):
    return spark.createDataFrame([], "as_of_date string, fingerprint string, last_known_good string")


@query(
    "update_benchmark",
    with_ctes("benchmark_bars", f"SELECT {NAMES} FROM benchmark_bars WHERE date <= DATE '2001-10-31'"),
)
def update_benchmark(spark, folder):
    root = new_folder(spark, "benchmark")
    bars = fx.benchmark_bars(spark, folder).withColumn("src_ord", F.unix_date("date"))
    jobs.update_benchmark(spark, bars.filter(F.col("date") <= B.SPLIT_DAY), root, B.SPLIT_DAY)
    jobs.update_benchmark(spark, bars.filter(F.col("date") >= B.OVERLAP_DAY), root, date(2001, 10, 31))
    return P.load_snapshot(spark, root)[0].select(*BAR_COLUMNS)


@query("ema_promotion", with_ctes("bars", "SELECT * FROM state", state=Q.bootstrap_sql("bars")))
def ema_promotion(spark, folder):
    root = new_folder(spark, "ema")
    # state is made of these columns alone, so no others are derived, moved and written
    bars = clustered(fx.bars(spark, folder).select(*E.SOURCE_COLUMNS), "bars")
    ready = clustered(W.rolling_tail(bars), "tail")
    last = ready.agg(F.max("date").alias("d")).first()["d"]
    jobs.build_and_promote_ema(
        spark, ready, "source-1", bars, Q._mixed_state(spark, folder, bars),
        f"{root}/published", f"{root}/candidate", last,
    )
    return P.load_ema_state(spark, f"{root}/published", "source-1").select(*EMA_STATE_COLUMNS)


# --- streams
@query(
    "stream_daily_bars",
    "WITH e AS (SELECT *, CAST(epoch_us(ts) AS HUGEINT) * 1000000000000 + event_id AS o FROM events)"
    " SELECT user_id AS security_id, CAST(ts AS DATE) AS date, arg_min(value, o) AS open, max(value) AS high, min(value) AS low,"
    " arg_max(value, o) AS close, count(*) AS volume FROM e GROUP BY 1, 2",
)
def stream_daily_bars(spark, folder):
    # the events land as files in shuffled time order, so most ticks come late
    base = new_folder(spark, "stream")
    events = fx.table(spark, folder, "events")
    events.repartition(6, F.xxhash64("event_id")).write.parquet(f"{base}/landed")
    stream = T.read_files_as_stream(spark, f"{base}/landed", events.schema, files_per_trigger=1)
    ticks = stream.select(F.col("user_id").alias("security_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    return T.stream_daily_bars(ticks, f"{base}/run")


def _land_in_order(spark, bars, path):
    """Bars landed as three deliveries in date order, from the first date to the last."""
    edges = [None, date(2001, 8, 1), date(2001, 9, 15), None]
    for start, end in zip(edges, edges[1:]):
        part = bars if start is None else bars.filter(F.col("date") > start)
        part = part if end is None else part.filter(F.col("date") <= end)
        part.repartition("security_id").write.mode("append").parquet(path)
    return T.read_files_as_stream(spark, path, BARS, files_per_trigger=8)


@query("stream_ema", with_ctes("bars", "SELECT * FROM state", state=Q.bootstrap_sql("bars")))
def stream_ema(spark, folder):
    base = new_folder(spark, "stream")
    before = fx.bars(spark, folder).filter(F.col("date") <= Q.STATE_DAY)
    state = E.bootstrapped(before, True)
    after = fx.bars(spark, folder).filter(F.col("date") > Q.STATE_DAY)
    return T.stream_ema(_land_in_order(spark, after, f"{base}/landed"), state, f"{base}/run")


@query("stream_ema_any_order", with_ctes("bars", "SELECT * FROM state", state=Q.bootstrap_sql("bars")))
def stream_ema_any_order(spark, folder):
    """Bars after the state day in four deliveries of mixed dates: late ones rebuild their securities."""
    base = new_folder(spark, "stream")
    before = clustered(fx.bars(spark, folder).filter(F.col("date") <= Q.STATE_DAY), "before")
    after = fx.bars(spark, folder).filter(F.col("date") > Q.STATE_DAY)
    after.repartition(4, F.xxhash64("date")).write.parquet(f"{base}/landed")
    stream = T.read_files_as_stream(spark, f"{base}/landed", BARS, files_per_trigger=1)
    return T.stream_ema(stream, E.bootstrapped(before, True), f"{base}/run", history=before, compact_every=2)


@query(
    "stream_finalize",
    with_ctes(
        "bars",
        """SELECT CASE WHEN date > DATE '2001-10-31' THEN 'not_final' WHEN date <= DATE '2001-07-31' THEN 'late' ELSE 'final' END AS stream_class,
 count(*) AS bars, count(DISTINCT security_id) AS securities FROM bars GROUP BY 1""",
    ),
)
def stream_finalize(spark, folder):
    base = new_folder(spark, "stream")
    out = T.stream_finalize(
        _land_in_order(spark, fx.bars(spark, folder), f"{base}/landed"), f"{base}/run", date(2001, 10, 31), date(2001, 7, 31)
    )
    return out.groupBy("stream_class").agg(
        F.count("*").alias("bars"), F.count_distinct("security_id").alias("securities")
    )


# Two snapshots that lack every seventh bar and every tenth security; then all bars
# arrive, some with another close, and some of them a second time.
LATE_DAYS = (date(1999, 6, 30), date(2001, 3, 31))
LATE_WINDOW = 300
_late_epoch = lambda day: f"""SELECT *, DATE '{day}' AS as_of_date FROM keyed_bars
 WHERE date <= DATE '{day}' AND n % 7 <> 3 AND suppkey % 10 <> 9
 QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY date DESC) <= {LATE_WINDOW}"""  # noqa: E731


@query(
    "stream_late_arrivals",
    with_ctes(
        "keyed_bars",
        f"""SELECT as_of_date, reason, detail, count(*) AS bars, count(DISTINCT security_id) AS securities FROM (
 SELECT d.as_of_date, k.security_id, CASE WHEN b.w IS NULL THEN 'security_set_changed' WHEN e.security_id IS NOT NULL AND k.suppkey % 10 = 4 AND k.close <> 0 THEN 'overlap_values_changed'
   WHEN e.security_id IS NOT NULL THEN 'not_balanced_window_shift' WHEN b.w < {LATE_WINDOW} THEN 'per_security_row_counts_changed'
   WHEN k.date > b.f THEN 'pure_late_arrival_window_advance' ELSE 'not_balanced_window_shift' END AS reason,
  CASE WHEN b.w IS NULL THEN NULL WHEN e.security_id IS NOT NULL AND k.suppkey % 10 = 4 AND k.close <> 0 THEN 'close' WHEN e.security_id IS NOT NULL THEN 'equal_bar'
   WHEN b.w < {LATE_WINDOW} OR k.date > b.f THEN NULL ELSE 'before_window' END AS detail
 FROM keyed_bars k JOIN days d ON k.date <= d.as_of_date LEFT JOIN epochs e ON e.as_of_date = d.as_of_date AND e.security_id = k.security_id AND e.date = k.date
 LEFT JOIN (SELECT as_of_date, security_id, count(*) AS w, min(date) AS f FROM epochs GROUP BY 1, 2) b ON b.as_of_date = d.as_of_date AND b.security_id = k.security_id
 UNION ALL SELECT d.as_of_date, k.security_id, 'duplicate_keys', NULL FROM keyed_bars k JOIN days d ON k.date <= d.as_of_date WHERE k.n % 11 = 5) GROUP BY 1, 2, 3""",
        days=f"SELECT unnest([{', '.join(f"DATE '{d}'" for d in LATE_DAYS)}]) AS as_of_date",
        epochs=" UNION ALL ".join(f"({_late_epoch(d)})" for d in LATE_DAYS),
    ),
)
def stream_late_arrivals(spark, folder):
    base = new_folder(spark, "stream")
    keyed = materialize(fx.keyed_bars(spark, folder), "keyed")
    epochs = {}
    for day in LATE_DAYS:
        held = keyed.filter((F.col("date") <= day) & (F.col("n") % 7 != 3) & (F.col("suppkey") % 10 != 9))
        epochs[day] = W.rolling_tail(held.select(*BAR_COLUMNS), LATE_WINDOW)
    sent = keyed.withColumn("close", F.expr("CASE WHEN suppkey % 10 = 4 THEN close * 2 ELSE close END"))
    for part in (sent, sent.filter("n % 11 = 5")):
        part.select(*BAR_COLUMNS).coalesce(2).write.mode("append").option("compression", "zstd").parquet(f"{base}/landed")
    stream = T.read_files_as_stream(spark, f"{base}/landed", BARS, files_per_trigger=1)
    out = T.stream_late_arrivals(stream, epochs, f"{base}/run", LATE_WINDOW)
    return out.groupBy("as_of_date", "reason", "detail").agg(
        F.count("*").alias("bars"), F.count_distinct("security_id").alias("securities")
    )


# --- a repair that stops half way
_REPAIR_CTES = dict(
    sent=f"SELECT {NAMES} FROM provider_b WHERE date = DATE '{B.UPSERT_DAY}'",
    # the second provider's closes may leave the range of their bar, which is refused
    fresh="SELECT * FROM sent WHERE low > 0 AND close BETWEEN low AND high AND open BETWEEN low AND high",
    old=f"SELECT {NAMES} FROM bars WHERE date = DATE '{B.UPSERT_DAY}'",
    wanted="SELECT DISTINCT security_id FROM bars",
)
REPAIR_PARTS = 16


def _stopped_repair(spark, folder):
    """A repair of one day from the second provider, stopped between two steps and run again."""
    base = new_folder(spark, "repair")
    bars = materialize(fx.bars(spark, folder), "bars")
    RP.write_parts(bars, f"{base}/history", REPAIR_PARTS)
    fresh = fx.provider_b(spark, folder)

    def run(stop=None):
        ids = bars.select("security_id")
        return RP.repair_session(spark, f"{base}/history", fresh, B.UPSERT_DAY, f"{base}/log", REPAIR_PARTS, 4, ids, stop)

    class Stopped(Exception):
        pass

    def half_way(step):
        if step.startswith("new"):
            raise Stopped

    try:
        run(half_way)
    except Stopped:
        pass
    return run(), RP.read_parts(spark, f"{base}/history").select(*BAR_COLUMNS)


@query(
    "repair_session",
    with_ctes(
        "bars provider_b",
        f"SELECT {NAMES} FROM bars WHERE date <> DATE '{B.UPSERT_DAY}' UNION ALL SELECT {NAMES} FROM fresh"
        f" UNION ALL SELECT {NAMES} FROM old WHERE security_id NOT IN (SELECT security_id FROM fresh)",
        **_REPAIR_CTES,
    ),
)
def repair_session(spark, folder):
    return _stopped_repair(spark, folder)[1]


@query(
    "repair_session_report",
    with_ctes(
        "bars provider_b",
        f"""SELECT security_id, CASE WHEN s.date IS NULL THEN 'missing_source' WHEN f.date IS NULL THEN 'unsound_bar' WHEN o.date IS NULL THEN 'added'
 WHEN {' OR '.join(f'o.{c} IS DISTINCT FROM f.{c}' for c in BAR_COLUMNS if c != 'security_id')} THEN 'changed' ELSE 'same' END AS action,
 o.close AS before_close, f.close AS after_close
 FROM wanted LEFT JOIN sent s USING (security_id) LEFT JOIN fresh f USING (security_id) LEFT JOIN old o USING (security_id)""",
        **_REPAIR_CTES,
    ),
)
def repair_session_report(spark, folder):
    return _stopped_repair(spark, folder)[0]
