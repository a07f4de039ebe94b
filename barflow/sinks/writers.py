"""Writers: bars, daily cross-sections, issue lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.keep import keep_last
from barflow.schemas import BAR_COLUMNS, BARS, ContractError, require_columns
from barflow.session import new_folder, path_exists


def write_bars(bars: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write bars as zstd Parquet clustered by year and security and return what was written.

    Rows are dealt out by ranges of (year, security_id) and sorted so within each
    file. A file spans few years and few securities, so its statistics let later
    reads by date or by security skip it. Ranges follow the data, so no year and
    no security makes a large file alone.
    """
    require_columns(bars, BAR_COLUMNS, "bars")
    cluster = [F.year("date"), F.col("security_id")]
    rows = bars.select(*BAR_COLUMNS).repartitionByRange(*cluster).sortWithinPartitions(*cluster, "date")
    rows.write.mode(mode).option("compression", "zstd").parquet(path)
    written = bars.sparkSession.read.schema(BARS).parquet(path)
    if written.isEmpty():
        raise ContractError(f"nothing was written to {path}")
    return written


def upsert_daily(spark: SparkSession, path: str, additions: DataFrame, order_col: str) -> DataFrame:
    """Merge new bars into the per-date cross-sections below ``path``; the new row wins.

    Of a bar added twice the row with the greatest ``order_col`` counts. Only the
    partitions of the added dates are read and replaced. The merged
    partitions are first written to the shared folder, so the final overwrite
    never reads what it replaces. Returns the dates and rows written.
    """
    extra = [order_col] if order_col not in BAR_COLUMNS else []
    key = ["date", "security_id"]
    new = keep_last(additions.select(*BAR_COLUMNS, *extra), key, [order_col]).select(*BAR_COLUMNS)
    merged = new
    # the first run has no folder yet
    if path_exists(spark, path):
        stored = spark.read.schema(BARS).parquet(path)
        dates = new.select("date").distinct()
        touched = stored.join(dates, "date", "left_semi")
        kept = touched.join(new.select(*key), key, "left_anti")
        merged = kept.select(*BAR_COLUMNS).unionByName(new)
    staging = new_folder(spark, "upsert")
    merged.write.parquet(staging)
    staged = spark.read.schema(BARS).parquet(staging)
    (
        # an update often has one date only: rebalancing still spreads its rows
        staged.hint("rebalance", "date")
        .sortWithinPartitions("date", "security_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("date")
        .parquet(path)
    )
    return staged.groupBy("date").agg(F.count("*").alias("rows"))


def write_issue_csv(rows: DataFrame, path: str, issues_col: str = "issues") -> None:
    """Rows as CSV with the issue array joined by ``|``."""
    flat = rows.withColumn(issues_col, F.array_join(F.col(issues_col), "|"))
    flat.write.mode("errorifexists").option("header", "true").csv(path)
