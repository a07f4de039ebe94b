"""Bar store clustered by security: tails, folds and gates over stored bars need no shuffle.

Bars are written into buckets of ``security_id``, sorted by date, and read as a
table that knows them. Windows and groupings by security, or by security and
date, then run where the buckets lie. A security has at most one bar a date in
the store, so that the calendar bounds what any one of them adds to a bucket,
whatever its share of the rows written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barflow.functions.keep import keep_last
from barflow.schemas import BAR_COLUMNS, BAR_KEY, BARS, ContractError, require_columns

# Bars that a bucket holds on average: some thousand securities of forty years.
BUCKET_BARS = 10_000_000
CLUSTER = ["security_id", "date"]


def bucket_count(bars: int) -> int:
    """Buckets for a number of bars; one that grows is better begun with room."""
    return max(1, -(-bars // BUCKET_BARS))


def _one_per_date(bars: DataFrame) -> DataFrame:
    """One bar per security and date, that of the greatest values, reduced on the map side."""
    order = [c for c in BAR_COLUMNS if c not in BAR_KEY]
    return keep_last(bars.select(*BAR_COLUMNS), BAR_KEY, order).filter("date is not null and security_id is not null")


def _write(bars: DataFrame, table: str, path: str, buckets: int, mode: str) -> None:
    dealt = bars.select(*BAR_COLUMNS).repartition(buckets, "security_id").sortWithinPartitions(*CLUSTER)
    out = dealt.write.mode(mode).format("parquet").option("compression", "zstd").option("path", path)
    out.bucketBy(buckets, "security_id").sortBy(*CLUSTER).saveAsTable(table)


def create_bar_store(bars: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write bars as a new store and return it; repeated and dateless bars are settled first."""
    require_columns(bars, BAR_COLUMNS, "bars")
    _write(_one_per_date(bars), table, path, buckets, "errorifexists")
    return bars.sparkSession.table(table)


def open_bar_store(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """Name a stored folder in this session's catalog; it must have been written with as many buckets."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BARS.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (security_id) "
        f"SORTED BY ({', '.join(CLUSTER)}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)


def bucket_spec(spark: SparkSession, table: str) -> int:
    """Number of buckets of a store; an error where the table is not clustered by security."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if facts.get("Bucket Columns", "").replace("`", "") != "[security_id]":
        raise ContractError(f"{table} is not clustered by security")
    return int(facts["Num Buckets"])


def append_to_bar_store(spark: SparkSession, table: str, new_rows: DataFrame) -> DataFrame:
    """Add bars of keys that the store lacks; bars whose key it holds are left out.

    Only the keys of the store are read, in place; the new bars alone are shuffled.
    """
    buckets = bucket_spec(spark, table)
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    held = spark.table(table).select(*BAR_KEY)
    _write(_one_per_date(new_rows).join(held, BAR_KEY, "left_anti"), table, facts["Location"], buckets, "append")
    spark.catalog.refreshTable(table)
    return spark.table(table)
