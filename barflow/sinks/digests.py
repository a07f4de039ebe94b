"""Snapshots with a tree of digests: root, years, and leaves of a year and a part of the securities.

A leaf's digest sums slices of its rows' hashes, as the content fingerprint
does, so a year's digest is the sum of its leaves and the root that of its
years: no row is read twice, and rows may come in any order. Rows are stored one
folder a leaf. A load checks only the leaves that it reads, and two snapshots
are compared by descending where digests differ; equal leaves are never opened.

There are at most years x parts leaves, whatever the number of rows, and only
leaf names come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.merge import raise_on_rows
from barflow.schemas import BAR_COLUMNS, BAR_KEY, BAR_VALUES, BARS, require_columns
from barflow.sinks.publish import fingerprint_aggregates

# Parts of the securities; with forty years, some ten thousand leaves.
PARTS = 256
_STORED = T.StructType([*BARS.fields, T.StructField("leaf", T.StringType())])
_SUMS = ["rows", "h0", "h1", "h2", "h3"]


def _leaf(parts: int) -> Column:
    """Name of a row's leaf: its year (none without a date) and its security's part."""
    year = F.coalesce(F.date_format("date", "yyyy"), F.lit("none"))
    part = F.pmod(F.xxhash64("security_id"), F.lit(parts)).cast("string")
    return F.concat(year, F.lit("-"), part)


def leaf_digests(bars: DataFrame) -> DataFrame:
    """(leaf, rows, h0..h3) of bars that carry their ``leaf``."""
    return bars.groupBy("leaf").agg(*fingerprint_aggregates(BAR_COLUMNS))


def year_digests(leaves: DataFrame) -> DataFrame:
    """(year, rows, h0..h3): the sums of each year's leaves."""
    year = F.substring_index("leaf", "-", 1).alias("year")
    return leaves.groupBy(year).agg(*[F.sum(c).cast(leaves.schema[c].dataType).alias(c) for c in _SUMS])


def root_digest(leaves: DataFrame) -> tuple:
    """Sums over all leaves, from the years."""
    return tuple(year_digests(leaves).agg(*[F.sum(c) for c in _SUMS]).first())


def write_digested(bars: DataFrame, path: str, parts: int = PARTS) -> None:
    """Write bars by leaf and, last, the digests of what was written."""
    rows = require_columns(bars, BAR_COLUMNS, "bars").select(*BAR_COLUMNS).withColumn("leaf", _leaf(parts))
    # a leaf of many rows is spread by rebalancing, small ones share tasks
    dealt = rows.hint("rebalance", "leaf").sortWithinPartitions("leaf", "security_id", "date")
    dealt.write.mode("errorifexists").option("compression", "zstd").partitionBy("leaf").parquet(f"{path}/bars")
    leaf_digests(_stored(bars.sparkSession, path)).coalesce(1).write.mode("errorifexists").parquet(f"{path}/leaves")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(f"{path}/bars")


def read_leaves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/leaves")


def load_digested(
    spark: SparkSession, path: str, years: Sequence[int] | None = None, security_ids: Sequence[str] | None = None, parts: int = PARTS
) -> DataFrame:
    """Bars of some years and securities (all where none are named), after a check of the leaves that hold them."""
    leaves, stored = read_leaves(spark, path), _stored(spark, path)
    name = F.col("leaf")
    if years is not None:
        leaves = leaves.filter(F.substring_index(name, "-", 1).isin([f"{y:04d}" for y in years]))
    if security_ids is not None:
        held = spark.createDataFrame([(s,) for s in security_ids], "security_id string")
        part = held.select(F.pmod(F.xxhash64("security_id"), F.lit(parts)).cast("string").alias("part")).distinct()
        leaves = leaves.filter(F.substring_index(name, "-", -1).isin([r.part for r in part.collect()]))
    picked = stored.filter(name.isin([r.leaf for r in leaves.select("leaf").collect()]))
    raise_on_rows(unequal_leaves(leaves, leaf_digests(picked)), f"snapshot {path} differs from its digests")
    if years is not None:
        picked = picked.filter(F.year("date").isin(list(years)))
    if security_ids is not None:
        picked = picked.filter(F.col("security_id").isin(list(security_ids)))
    return picked.select(*BAR_COLUMNS)


def unequal_leaves(one: DataFrame, other: DataFrame) -> DataFrame:
    """(leaf, change) where two leaf tables differ: by years first, then within the unequal years."""
    years = _unequal(year_digests(one), year_digests(other), "year").select("year")
    within = lambda t: t.withColumn("year", F.substring_index("leaf", "-", 1)).join(years, "year", "left_semi")
    return _unequal(within(one), within(other), "leaf")


def _unequal(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    left = one.select(key, F.struct(*_SUMS).alias("l"))
    right = other.select(key, F.struct(*_SUMS).alias("r"))
    change = F.when(F.col("l").isNull(), "added").when(F.col("r").isNull(), "removed").otherwise("changed")
    both = left.join(right, key, "full_outer")
    return both.filter(~F.col("l").eqNullSafe(F.col("r"))).select(key, change.alias("change"))


def changed_bars(spark: SparkSession, canonical: str, candidate: str) -> DataFrame:
    """Keys at which two snapshots differ, with the change and the fields that differ.

    Both must have been written with as many parts. Only leaves with unequal
    digests are read. A key that a side holds more than once is ``repeated``.
    """
    leaves = unequal_leaves(read_leaves(spark, canonical), read_leaves(spark, candidate))
    named = [r.leaf for r in leaves.select("leaf").collect()]
    fields = ["ticker", *BAR_VALUES]

    def side(path: str, prefix: str) -> DataFrame:
        rows = _stored(spark, path).filter(F.col("leaf").isin(named))
        held = rows.groupBy(*BAR_KEY).agg(F.count("*").alias(f"{prefix}_rows"), F.min(F.struct(*fields)).alias(prefix))
        return held.select(F.col("security_id").alias(f"{prefix}_id"), F.col("date").alias(f"{prefix}_date"), f"{prefix}_rows", prefix)

    same_key = F.col("a_id").eqNullSafe(F.col("b_id")) & F.col("a_date").eqNullSafe(F.col("b_date"))
    both = side(canonical, "a").join(side(candidate, "b"), same_key, "full_outer")
    differing = F.filter(
        F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in fields]), lambda c: c.isNotNull()
    )
    change = (
        F.when(F.col("a_rows").isNull(), "added")
        .when(F.col("b_rows").isNull(), "removed")
        .when((F.col("a_rows") > 1) | (F.col("b_rows") > 1), "repeated")
        .when(F.size(differing) > 0, "changed")
    )
    found = both.withColumn("change", change).filter(F.col("change").isNotNull())
    return found.select(
        F.coalesce("a_id", "b_id").alias("security_id"),
        F.coalesce("a_date", "b_date").alias("date"),
        "change",
        F.when(F.col("change") == "changed", F.array_join(differing, "|")).alias("fields"),
    )
