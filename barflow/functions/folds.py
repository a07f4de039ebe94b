"""Ordered folds over one security's dated values.

Each fold takes an ``array<struct<date, ...>>`` that holds at most one entry per
calendar date, so its length is bounded by the calendar and not by row counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barflow.schemas import EMA_PERIODS


def _step(price: Column, state: Column, period: int) -> Column:
    alpha = 2.0 / (period + 1.0)
    return F.lit(alpha) * price + F.lit(1.0 - alpha) * state


def ema_fold(prices: Column, seed: Column | None = None) -> Column:
    """Fold ``array<double>`` into ``struct<ema20, ema50, ema150, ema200>``.

    Without ``seed`` the first price seeds every period and the fold starts at
    the second one. The recurrence is evaluated term by term in date order, as a
    closed form would round differently.
    """
    if seed is None:
        first = F.element_at(prices, 1)
        seed = F.struct(*[first.alias(f"ema{p}") for p in EMA_PERIODS])
        prices = F.slice(prices, 2, F.greatest(F.size(prices) - 1, F.lit(0)))
    return F.aggregate(
        prices,
        seed,
        lambda acc, price: F.struct(
            *[_step(price, acc.getField(f"ema{p}"), p).alias(f"ema{p}") for p in EMA_PERIODS]
        ),
    )


def product_fold(factors: Column) -> Column:
    """Left-to-right product of ``array<double>``; 1.0 when empty or NULL."""
    return F.coalesce(F.aggregate(factors, F.lit(1.0), lambda acc, f: acc * f), F.lit(1.0))
