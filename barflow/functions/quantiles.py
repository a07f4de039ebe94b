"""Exact quantiles without bringing all values to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slices per power of two, and finer cells per slice. They only spread the work;
# any numbers are exact. Doubles span fewer than 2,100 powers of two, so a group
# has at most about two million slices whatever the number of rows.
SLICES = 1024
CELLS = 65536


def _ranked(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``first`` and ``last``: ranks before and up to each row within ``keys``."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum("n").over(upto)
    return counts.withColumn("last", last).withColumn("first", F.col("last") - F.col("n"))


def _inside() -> Column:
    return (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles with linear interpolation of the non-negative column ``value``.

    Equal values are counted first, so a value that most rows share is one row
    from then on. The counts of slices of the value range tell which slice holds
    each wanted rank, the counts of that slice's cells which cell, and only the
    distinct values of those cells are ranked one by one. Returns ``by`` columns,
    ``probability``, ``quantile``.
    """
    by = list(by)
    keys = by or ["__all"]
    work = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    if not by:
        work = work.withColumn("__all", F.lit(1))
    counts = work.groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    scaled = F.log2("v") * F.lit(SLICES)
    positive = F.col("v") > 0
    counts = counts.withColumn(
        "slice", F.when(positive, F.floor(scaled)).otherwise(F.lit(-(2**40)))
    ).withColumn(
        "cell", F.when(positive, F.floor((scaled - F.floor(scaled)) * F.lit(CELLS))).otherwise(F.lit(0))
    )

    slices = counts.groupBy(*keys, "slice").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys)
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    position = F.col("probability") * (F.col("total") - 1)
    in_slice = (
        _ranked(slices, keys, "slice")
        .withColumn("total", F.sum("n").over(whole))
        .withColumn("probability", F.explode(probs))
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array(F.floor("position"), F.ceil("position"))))
        .filter(_inside())
        .select(*keys, "slice", "probability", "position", "rank", F.col("first").alias("base"))
        .distinct()
    )
    hot = counts.join(in_slice.select(*keys, "slice").distinct(), [*keys, "slice"])

    cells = hot.groupBy(*keys, "slice", "cell").agg(F.sum("n").alias("n"))
    at = [*keys, "slice", "cell"]
    in_cell = (
        in_slice.join(_ranked(cells, [*keys, "slice"], "cell"), [*keys, "slice"])
        .withColumns({"first": F.col("base") + F.col("first"), "last": F.col("base") + F.col("last")})
        .filter(_inside())
        .select(*at, "probability", "position", "rank", F.col("first").alias("base"))
    )
    values = _ranked(hot.join(in_cell.select(*at).distinct(), at), at, "v")
    found = (
        in_cell.join(values.select(*at, "v", "first", "last"), at)
        .withColumns({"first": F.col("base") + F.col("first"), "last": F.col("base") + F.col("last")})
        .filter(_inside())
    )
    out = found.groupBy(*keys, "probability", "position").agg(
        F.min_by("v", "rank").alias("lo"), F.max_by("v", "rank").alias("hi"), F.min("rank").alias("base")
    )
    weight = F.col("position") - F.col("base")
    value_at = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
        F.col("lo") * (1.0 - weight) + F.col("hi") * weight
    )
    return out.select(*by, "probability", value_at.alias("quantile"))
