"""Market-shaped inputs derived from the star-schema tables, in Spark and in SQL.

Each Spark function has a same-named entry in ``CTE``; both state the same
expressions, so a query and its SQL check start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.schemas import BAR_COLUMNS

FIRST_BAR = "1995-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def padded(key: str, prefix: str = "S") -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 10, "0"))


def day_of(column: str) -> Column:
    return F.col(column).cast("date")


def _sql_id(key: str, prefix: str = "S") -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), 10, '0')"


# A total order of trades as one number: a struct would force sort-based
# aggregation, a decimal keeps the hash aggregate.
_TRADE_ORDER = (
    "cast(l_orderkey * 8 + l_linenumber as decimal(20, 0)) * cast(1000000000000 as decimal(13, 0))"
    " + cast((cast(round(l_extendedprice * 100) as bigint) * 64 + cast(l_quantity as bigint)) * 128"
    " + cast(round(l_discount * 100) as bigint) as decimal(13, 0))"
)


def keyed_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with the numeric supplier key and ``n``, the key plus the day number."""
    px = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.expr(_TRADE_ORDER)
    agg = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", day_of("l_shipdate").alias("date"))
        .agg(
            F.min_by(px, order).alias("open"),
            F.max(px).alias("high"),
            F.min(px).alias("low"),
            F.max_by(px, order).alias("close"),
            F.max_by("l_discount", order).alias("discount"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
    )
    return agg.select(
        "date",
        padded("l_suppkey").alias("security_id"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("ticker"),
        "open",
        "high",
        "low",
        "close",
        (F.col("close") * (1.0 - F.col("discount"))).alias("adj_close"),
        "volume",
        F.col("l_suppkey").alias("suppkey"),
        (F.col("l_suppkey") + F.datediff("date", F.lit(FIRST_BAR).cast("date"))).alias("n"),
    )


def bars(spark: SparkSession, folder: str) -> DataFrame:
    return keyed_bars(spark, folder).select(*BAR_COLUMNS)


def event_bars(spark: SparkSession, folder: str) -> DataFrame:
    ev = table(spark, folder, "events")
    # microseconds and the event id as one number, again to keep the hash aggregate
    order = F.expr("cast(unix_micros(cast(ts as timestamp)) as decimal(20, 0)) * 1000000000000 + event_id")
    return (
        ev.groupBy("user_id", day_of("ts").alias("date"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.count("*").alias("volume"),
        )
        .select(
            "date",
            padded("user_id", "U").alias("security_id"),
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
            "open",
            "high",
            "low",
            "close",
            F.col("close").alias("adj_close"),
            "volume",
        )
    )


def _when(test: str, changed: str, column: str) -> Column:
    return F.expr(f"CASE WHEN {test} THEN {changed} ELSE {column} END").alias(column)


def dirty_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with defects planted by ``n``: range, sign, volume, NULL and NaN."""
    return dirtied(keyed_bars(spark, folder))


def dirtied(keyed: DataFrame) -> DataFrame:
    return keyed.select(
        "date",
        "security_id",
        "ticker",
        _when("n % 89 = 0", "-open", "open"),
        _when("n % 97 = 0", "low * 0.5D", "high"),
        "low",
        _when("n % 79 = 0", "NULL", "close"),
        _when("n % 73 = 0", "double('NaN')", "adj_close"),
        _when("n % 83 = 0", "-1L", "volume"),
    )


def raw_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Source rows in provider order: repeated dates, incomplete rows, and some bad securities."""
    return raw_of(keyed_bars(spark, folder))


def raw_of(k: DataFrame) -> DataFrame:
    copies = F.when(F.col("n") % 13 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = k.select("*", F.explode(copies).alias("copy"))
    return rows.select(
        "date",
        "security_id",
        "ticker",
        "open",
        F.expr(
            "CASE WHEN n % 17 = 0 AND copy = 0 THEN NULL"
            " WHEN suppkey % 5 = 0 AND n % 97 = 0 THEN low * 0.5D ELSE high END"
        ).alias("high"),
        "low",
        "close",
        "adj_close",
        F.expr("CASE WHEN n % 19 = 0 THEN NULL ELSE volume + copy END").alias("volume"),
        (F.datediff("date", F.lit(FIRST_BAR).cast("date")) * 2 + F.col("copy")).cast("long").alias("src_ord"),
    )


def provider_b(spark: SparkSession, folder: str) -> DataFrame:
    """A second provider: later start, some closes and volumes differ."""
    return keyed_bars(spark, folder).filter(F.col("date") >= F.lit("1995-06-01").cast("date")).select(
        "date",
        "security_id",
        "ticker",
        "open",
        "high",
        "low",
        _when("n % 7 = 0", "close * 1.001D", "close"),
        _when("n % 7 = 0", "adj_close * 1.001D", "adj_close"),
        _when("n % 11 = 0", "volume + 1", "volume"),
    )


def provider_a(spark: SparkSession, folder: str) -> DataFrame:
    return bars(spark, folder).filter(F.col("date") < F.lit("2001-06-01").cast("date"))


def benchmark_bars(spark: SparkSession, folder: str) -> DataFrame:
    """A market-wide benchmark: one bar per day over all trades."""
    px = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.expr(_TRADE_ORDER)
    agg = (
        table(spark, folder, "lineitem")
        .groupBy(day_of("l_shipdate").alias("date"))
        .agg(
            F.min_by(px, order).alias("open"),
            F.max(px).alias("high"),
            F.min(px).alias("low"),
            F.max_by(px, order).alias("close"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
    )
    return agg.select(
        "date",
        F.lit("benchmark:B0").alias("security_id"),
        F.lit("B0").alias("ticker"),
        "open",
        "high",
        "low",
        "close",
        F.col("close").alias("adj_close"),
        "volume",
    )


def members(spark: SparkSession, folder: str, later: bool = False) -> DataFrame:
    """Membership snapshot; the later one flips some ratings and renames some tickers."""
    s, n, r = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    rating = "CASE WHEN s_suppkey % 7 = 0 THEN 'DOUBTFUL' WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'COMPLIANT' END"
    ticker = "concat('T', cast(s_suppkey as string))"
    if later:
        rating = (
            f"CASE WHEN s_suppkey % 13 = 0 AND coalesce({rating}, '') = 'COMPLIANT' THEN 'DOUBTFUL'"
            f" WHEN s_suppkey % 13 = 0 THEN 'COMPLIANT' ELSE {rating} END"
        )
        ticker = f"CASE WHEN s_suppkey % 17 = 0 THEN concat('X', cast(s_suppkey as string)) ELSE {ticker} END"
    return j.select(
        padded("s_suppkey").alias("security_id"),
        F.expr(ticker).alias("ticker"),
        F.col("s_name").alias("name"),
        F.col("r_name").alias("exchange"),
        F.expr(rating).alias("sharia_compliance"),
        F.col("s_suppkey").alias("suppkey"),
    )


def eligible_members(spark: SparkSession, folder: str) -> DataFrame:
    from barflow.operators.universe import eligible

    return eligible(members(spark, folder))


HISTORY_SINCE = "2001-10-28"


def history_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Securities that traded in the last days count as having history."""
    li = table(spark, folder, "lineitem")
    recent = li.filter(F.col("l_shipdate") >= F.lit(HISTORY_SINCE).cast("date"))
    return recent.select(padded("l_suppkey").alias("security_id")).distinct()


def earnings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their last order date as a recorded date, some blank or malformed."""
    c, o = table(spark, folder, "customer"), table(spark, folder, "orders")
    last = o.groupBy("o_custkey").agg(F.max(day_of("o_orderdate")).alias("last_order"))
    j = c.join(last, c.c_custkey == last.o_custkey, "left")
    return j.select(
        padded("c_custkey", "C").alias("security_id"),
        F.expr("CASE WHEN c_custkey % 23 = 0 THEN ' ' WHEN c_custkey % 29 = 0 THEN 'n/a'"
               " ELSE concat(cast(last_order as string), 'T00:00:00Z') END").alias("next_earnings_date"),
        F.expr("CASE WHEN c_custkey % 3 = 0 THEN '1999-01-01T10:00:00' END").alias("updated_at"),
        F.expr("CASE WHEN c_custkey % 5 = 0 THEN '2000-06-01' END").alias("updated_date"),
    )


def splits(spark: SparkSession, folder: str) -> DataFrame:
    """Split statements as provider text, with repeats, conflicts and malformed factors."""
    p, s = table(spark, folder, "part"), table(spark, folder, "supplier")
    n_suppliers = s.agg(F.count("*")).scalar()
    base = p.withColumn("suppkey", F.col("p_partkey") % n_suppliers)
    copies = F.when(F.col("p_partkey") % 4 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select("*", F.explode(copies).alias("copy")).select(
        padded("suppkey").alias("security_id"),
        F.expr("date_add(DATE'1995-06-01', cast((p_partkey * 13 + (p_partkey div 97) * 31) % 2000 as int))").alias("date"),
        F.expr(
            "CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 'x'"
            " WHEN p_partkey % 41 = 0 THEN '0' WHEN p_partkey % 6 = 0 THEN '10.0'"
            " WHEN p_partkey % 6 = 1 THEN '1.0' WHEN p_partkey % 12 = 8 AND copy = 1 THEN '4.0'"
            " WHEN p_partkey % 3 = 2 THEN '2.0' ELSE '0.1' END"
        ).alias("split_factor"),
        F.concat(F.lit("T"), F.col("suppkey").cast("string")).alias("provider_ticker"),
    )


def clean_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Event rows of ``splits`` reduced to one row per key, conflicting keys left out."""
    from barflow.operators.corporate import split_dedupe, split_events

    facts = split_dedupe(split_events(splits(spark, folder)))
    return facts.filter(~F.col("conflict")).select("security_id", "effective_date", "split_factor", "provider_ticker")


def aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Two consecutive intervals per supplier ticker; some tickers were reused with an overlap."""
    s = table(spark, folder, "supplier")
    spans = F.array(F.lit(1), F.lit(2))
    return s.select("s_suppkey", F.explode(spans).alias("part")).select(
        F.expr("concat('S', lpad(cast(CASE WHEN part = 2 AND s_suppkey % 6 = 0 THEN s_suppkey + 1"
               " ELSE s_suppkey END as string), 10, '0'))").alias("security_id"),
        F.lit("Eod ").alias("provider"),
        F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("provider_ticker"),
        F.expr("CASE WHEN part = 2 AND s_suppkey % 12 = 0 THEN DATE'1997-12-01'"
               " WHEN part = 2 THEN DATE'1998-01-01' END").alias("valid_from"),
        F.expr("CASE WHEN part = 1 THEN DATE'1997-12-31' WHEN s_suppkey % 4 = 1 THEN DATE'2000-12-31' END")
        .alias("valid_to"),
        F.lit("reviewed").alias("evidence"),
    )


def lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier")
    return s.filter(F.col("s_acctbal") < 3000).select(
        padded("s_suppkey").alias("security_id"),
        F.expr(
            "CASE s_suppkey % 4 WHEN 0 THEN 'VERIFIED_TERMINATED_PUBLIC_LISTING'"
            " WHEN 1 THEN 'VERIFIED_NONTRADABLE_PRIMARY_EXCHANGE'"
            " WHEN 2 THEN 'VERIFIED_TICKER_CHANGE_SAME_SECURITY' ELSE 'REVIEW_REQUIRED' END"
        ).alias("lifecycle_status"),
        F.expr("CASE WHEN s_suppkey % 5 = 0 THEN NULL"
               " ELSE date_add(DATE'2001-01-01', cast(s_suppkey % 700 as int)) END").alias("effective_date"),
        F.concat(F.lit("N"), F.col("s_suppkey").cast("string")).alias("successor_ticker"),
        F.expr("concat('reason ', cast(s_suppkey % 9 as string))").alias("reason"),
    )


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Object keys and sizes from the web pages' paths."""
    return table(spark, folder, "pages").select(
        F.regexp_replace("url", "^https?://", "").alias("key"),
        F.length("html").cast("long").alias("size"),
    )


def securities(spark: SparkSession, folder: str) -> DataFrame:
    c, n = table(spark, folder, "customer"), table(spark, folder, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        padded("c_custkey", "C").alias("security_id"),
        F.expr("concat(substring(n_name, 1, 3), cast(c_custkey as string))").alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.expr("CASE WHEN c_custkey % 7 = 0 THEN 'DOUBTFUL' ELSE 'COMPLIANT' END").alias("sharia_compliance"),
        F.lit("2001-11-04").alias("universe_snapshot_date"),
    )


def fundamentals(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    return c.filter(F.col("c_acctbal") > 0).select(
        padded("c_custkey", "C").alias("security_id"),
        F.lower("c_mktsegment").alias("status"),
        F.lit("2001-09-30").alias("as_of_date"),
        F.lit("2001-10-15").alias("accepted_at"),
        F.lit("2001-09-30").alias("fiscal_period_end"),
        (F.col("c_acctbal") / 1000).alias("eps_yoy_latest"),
        (F.col("c_acctbal") / 2000).alias("eps_yoy_prior"),
        F.expr("CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal / 500 END").alias("revenue_yoy_latest"),
        (F.col("c_acctbal") / 700).alias("revenue_yoy_prior"),
        (F.col("c_acctbal") / 900).alias("annual_eps_growth"),
    )


def signals(spark: SparkSession, folder: str) -> DataFrame:
    """Every bar with more than one trade's volume span opens a signal at its close."""
    k = keyed_bars(spark, folder).filter(F.col("high") > F.col("low"))
    return k.select(
        F.concat_ws(":", "security_id", F.col("date").cast("string")).alias("signal_id"),
        "security_id",
        F.col("date").alias("signal_date"),
        F.expr("CASE WHEN n % 2 = 0 THEN 'breakout' ELSE 'pullback' END").alias("strategy"),
        F.lit("pending").alias("status"),
        F.lit(0).alias("days_in_status"),
        F.expr("CASE WHEN n % 2 = 0 THEN close * 1.02D ELSE close * 0.98D END").alias("entry_price"),
        (F.col("close") * 0.9).alias("stop_loss"),
        (F.col("close") * 1.2).alias("take_profit"),
    )


_PX = "l_extendedprice / l_quantity"
_SQL_ORDER = (
    "CAST(l_orderkey * 8 + l_linenumber AS HUGEINT) * 1000000000000"
    " + (CAST(round(l_extendedprice * 100) AS BIGINT) * 64 + CAST(l_quantity AS BIGINT)) * 128"
    " + CAST(round(l_discount * 100) AS BIGINT)"
)
_RATING = "CASE WHEN s_suppkey % 7 = 0 THEN 'DOUBTFUL' WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'COMPLIANT' END"
_BAR_LIST = ", ".join(BAR_COLUMNS)

# name -> (CTEs it reads, SELECT text); a CTE may read only earlier entries.
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "keyed_bars": (
        (),
        f"""SELECT date, {_sql_id('l_suppkey')} AS security_id, 'T' || CAST(l_suppkey AS VARCHAR) AS ticker,
        open, high, low, close, close * (1.0 - discount) AS adj_close, volume, l_suppkey AS suppkey,
        l_suppkey + date_diff('day', DATE '{FIRST_BAR}', date) AS n
        FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, arg_min({_PX}, {_SQL_ORDER}) AS open,
          max({_PX}) AS high, min({_PX}) AS low, arg_max({_PX}, {_SQL_ORDER}) AS close,
          arg_max(l_discount, {_SQL_ORDER}) AS discount, CAST(sum(l_quantity) AS BIGINT) AS volume
          FROM lineitem GROUP BY 1, 2)""",
    ),
    "bars": (("keyed_bars",), f"SELECT {_BAR_LIST} FROM keyed_bars"),
    "event_bars": (
        (),
        f"""SELECT date, {_sql_id('user_id', 'U')} AS security_id, 'U' || CAST(user_id AS VARCHAR) AS ticker,
        open, high, low, close, close AS adj_close, volume
        FROM (SELECT user_id, CAST(ts AS DATE) AS date, arg_min(value, o) AS open, max(value) AS high,
          min(value) AS low, arg_max(value, o) AS close, CAST(count(*) AS BIGINT) AS volume
          FROM (SELECT *, CAST(epoch_us(ts) AS HUGEINT) * 1000000000000 + event_id AS o FROM events)
          GROUP BY 1, 2)""",
    ),
    "dirty_bars": (
        ("keyed_bars",),
        """SELECT date, security_id, ticker, CASE WHEN n % 89 = 0 THEN -open ELSE open END AS open,
        CASE WHEN n % 97 = 0 THEN low * 0.5 ELSE high END AS high, low,
        CASE WHEN n % 79 = 0 THEN NULL ELSE close END AS close,
        CASE WHEN n % 73 = 0 THEN CAST('NaN' AS DOUBLE) ELSE adj_close END AS adj_close,
        CASE WHEN n % 83 = 0 THEN -1 ELSE volume END AS volume FROM keyed_bars""",
    ),
    "raw_rows": (
        ("keyed_bars",),
        f"""SELECT date, security_id, ticker, open,
        CASE WHEN n % 17 = 0 AND copy = 0 THEN NULL
             WHEN suppkey % 5 = 0 AND n % 97 = 0 THEN low * 0.5 ELSE high END AS high,
        low, close, adj_close, CASE WHEN n % 19 = 0 THEN NULL ELSE volume + copy END AS volume,
        CAST(date_diff('day', DATE '{FIRST_BAR}', date) * 2 + copy AS BIGINT) AS src_ord
        FROM keyed_bars, unnest(CASE WHEN n % 13 = 0 THEN [0, 1] ELSE [0] END) AS t(copy)""",
    ),
    "provider_a": (("bars",), "SELECT * FROM bars WHERE date < DATE '2001-06-01'"),
    "provider_b": (
        ("keyed_bars",),
        """SELECT date, security_id, ticker, open, high, low,
        CASE WHEN n % 7 = 0 THEN close * 1.001 ELSE close END AS close,
        CASE WHEN n % 7 = 0 THEN adj_close * 1.001 ELSE adj_close END AS adj_close,
        CASE WHEN n % 11 = 0 THEN volume + 1 ELSE volume END AS volume
        FROM keyed_bars WHERE date >= DATE '1995-06-01'""",
    ),
    "benchmark_bars": (
        (),
        f"""SELECT CAST(l_shipdate AS DATE) AS date, 'benchmark:B0' AS security_id, 'B0' AS ticker,
        arg_min({_PX}, {_SQL_ORDER}) AS open, max({_PX}) AS high, min({_PX}) AS low,
        arg_max({_PX}, {_SQL_ORDER}) AS close, arg_max({_PX}, {_SQL_ORDER}) AS adj_close,
        CAST(sum(l_quantity) AS BIGINT) AS volume FROM lineitem GROUP BY 1""",
    ),
    "members": (
        (),
        f"""SELECT {_sql_id('s_suppkey')} AS security_id, 'T' || CAST(s_suppkey AS VARCHAR) AS ticker,
        s_name AS name, r_name AS exchange, {_RATING} AS sharia_compliance, s_suppkey AS suppkey
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "members_later": (
        (),
        f"""SELECT {_sql_id('s_suppkey')} AS security_id,
        CASE WHEN s_suppkey % 17 = 0 THEN 'X' ELSE 'T' END || CAST(s_suppkey AS VARCHAR) AS ticker,
        s_name AS name, r_name AS exchange,
        CASE WHEN s_suppkey % 13 = 0 AND coalesce({_RATING}, '') = 'COMPLIANT' THEN 'DOUBTFUL'
             WHEN s_suppkey % 13 = 0 THEN 'COMPLIANT' ELSE {_RATING} END AS sharia_compliance,
        s_suppkey AS suppkey
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "eligible_members": (("members",), "SELECT * FROM members WHERE sharia_compliance = 'COMPLIANT'"),
    "history_ids": (
        (),
        f"""SELECT DISTINCT {_sql_id('l_suppkey')} AS security_id FROM lineitem
        WHERE l_shipdate >= DATE '{HISTORY_SINCE}'""",
    ),
    "earnings": (
        (),
        f"""SELECT {_sql_id('c_custkey', 'C')} AS security_id,
        CASE WHEN c_custkey % 23 = 0 THEN ' ' WHEN c_custkey % 29 = 0 THEN 'n/a'
             WHEN last_order IS NULL THEN NULL
             ELSE CAST(last_order AS VARCHAR) || 'T00:00:00Z' END AS next_earnings_date,
        CASE WHEN c_custkey % 3 = 0 THEN '1999-01-01T10:00:00' END AS updated_at,
        CASE WHEN c_custkey % 5 = 0 THEN '2000-06-01' END AS updated_date
        FROM customer LEFT JOIN (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_order
          FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
    ),
    "splits": (
        (),
        f"""SELECT {_sql_id('suppkey')} AS security_id,
        DATE '1995-06-01' + CAST((p_partkey * 13 + (p_partkey // 97) * 31) % 2000 AS INTEGER) AS date,
        CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 'x'
             WHEN p_partkey % 41 = 0 THEN '0' WHEN p_partkey % 6 = 0 THEN '10.0'
             WHEN p_partkey % 6 = 1 THEN '1.0' WHEN p_partkey % 12 = 8 AND copy = 1 THEN '4.0'
             WHEN p_partkey % 3 = 2 THEN '2.0' ELSE '0.1' END AS split_factor,
        'T' || CAST(suppkey AS VARCHAR) AS provider_ticker
        FROM (SELECT *, p_partkey % (SELECT count(*) FROM supplier) AS suppkey FROM part),
             unnest(CASE WHEN p_partkey % 4 = 0 THEN [0, 1] ELSE [0] END) AS t(copy)""",
    ),
    "clean_splits": (
        ("splits",),
        """SELECT security_id, date AS effective_date, min(f) AS split_factor, min(provider_ticker) AS provider_ticker
        FROM (SELECT *, try_cast(split_factor AS DOUBLE) AS f FROM splits)
        WHERE f > 0 AND f <> 1 GROUP BY 1, 2 HAVING max(f) - min(f) <= 1e-12""",
    ),
    "aliases": (
        (),
        f"""SELECT {_sql_id('CASE WHEN part = 2 AND s_suppkey % 6 = 0 THEN s_suppkey + 1 ELSE s_suppkey END')}
          AS security_id, 'Eod ' AS provider, 't' || CAST(s_suppkey AS VARCHAR) AS provider_ticker,
        CASE WHEN part = 2 AND s_suppkey % 12 = 0 THEN DATE '1997-12-01'
             WHEN part = 2 THEN DATE '1998-01-01' END AS valid_from,
        CASE WHEN part = 1 THEN DATE '1997-12-31' WHEN s_suppkey % 4 = 1 THEN DATE '2000-12-31' END AS valid_to,
        'reviewed' AS evidence FROM supplier, unnest([1, 2]) AS t(part)""",
    ),
    "lifecycle": (
        (),
        f"""SELECT {_sql_id('s_suppkey')} AS security_id,
        CASE s_suppkey % 4 WHEN 0 THEN 'VERIFIED_TERMINATED_PUBLIC_LISTING'
          WHEN 1 THEN 'VERIFIED_NONTRADABLE_PRIMARY_EXCHANGE'
          WHEN 2 THEN 'VERIFIED_TICKER_CHANGE_SAME_SECURITY' ELSE 'REVIEW_REQUIRED' END AS lifecycle_status,
        CASE WHEN s_suppkey % 5 = 0 THEN NULL
          ELSE DATE '2001-01-01' + CAST(s_suppkey % 700 AS INTEGER) END AS effective_date,
        'N' || CAST(s_suppkey AS VARCHAR) AS successor_ticker,
        'reason ' || CAST(s_suppkey % 9 AS VARCHAR) AS reason
        FROM supplier WHERE s_acctbal < 3000""",
    ),
    "inventory": (
        (),
        "SELECT regexp_replace(url, '^https?://', '') AS key, CAST(length(html) AS BIGINT) AS size FROM pages",
    ),
    "securities": (
        (),
        f"""SELECT {_sql_id('c_custkey', 'C')} AS security_id,
        substring(n_name, 1, 3) || CAST(c_custkey AS VARCHAR) AS ticker, c_name AS company_name,
        CASE WHEN c_custkey % 7 = 0 THEN 'DOUBTFUL' ELSE 'COMPLIANT' END AS sharia_compliance,
        '2001-11-04' AS universe_snapshot_date FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "fundamentals": (
        (),
        f"""SELECT {_sql_id('c_custkey', 'C')} AS security_id, lower(c_mktsegment) AS status,
        '2001-09-30' AS as_of_date, '2001-10-15' AS accepted_at, '2001-09-30' AS fiscal_period_end,
        c_acctbal / 1000 AS eps_yoy_latest, c_acctbal / 2000 AS eps_yoy_prior,
        CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal / 500 END AS revenue_yoy_latest,
        c_acctbal / 700 AS revenue_yoy_prior, c_acctbal / 900 AS annual_eps_growth
        FROM customer WHERE c_acctbal > 0""",
    ),
    "explorer": (
        ("securities", "fundamentals"),
        """SELECT s.*, f.status AS fundamental_status, f.as_of_date AS fundamental_as_of, f.accepted_at,
        f.fiscal_period_end, f.eps_yoy_latest, f.eps_yoy_prior, f.revenue_yoy_latest, f.revenue_yoy_prior,
        f.annual_eps_growth FROM securities s LEFT JOIN fundamentals f USING (security_id)""",
    ),
    "signals": (
        ("keyed_bars",),
        """SELECT security_id || ':' || CAST(date AS VARCHAR) AS signal_id, security_id, date AS signal_date,
        CASE WHEN n % 2 = 0 THEN 'breakout' ELSE 'pullback' END AS strategy,
        CASE WHEN n % 2 = 0 THEN close * 1.02 ELSE close * 0.98 END AS entry_price,
        close * 0.9 AS stop_loss, close * 1.2 AS take_profit FROM keyed_bars WHERE high > low""",
    ),
}


def with_ctes(names: str, body: str, **extra: str) -> str:
    """``WITH`` clause of the named fixtures (and ``extra`` CTEs after them) before ``body``."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for other in CTE[name][0]:
                add(other)
            needed.append(name)

    for name in names.split():
        add(name)
    parts = [f"{name} AS ({CTE[name][1]})" for name in needed]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}"
