"""Keep one row per key without ever gathering a key's rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = order[0] if len(order) == 1 else F.struct(*order)
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), ranked).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Row with the greatest ``order`` per key.

    ``max_by`` merges on the map side, so a key that holds a third of the rows
    reaches the reducer as one row per map task. ``order`` must be a total
    order within a key, else the choice among equals is arbitrary.
    """
    return _keep(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Row with the smallest ``order`` per key; see :func:`keep_last`."""
    return _keep(df, keys, order, F.min_by)
