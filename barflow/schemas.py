"""Column lists, schemas and the column check shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PRICES = ["open", "high", "low", "close", "adj_close"]
BAR_VALUES = [*PRICES, "volume"]
BAR_COLUMNS = ["date", "security_id", "ticker", *BAR_VALUES]
BAR_KEY = ["security_id", "date"]

BARS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("security_id", T.StringType()),
        T.StructField("ticker", T.StringType()),
        *[T.StructField(name, T.DoubleType()) for name in PRICES],
        T.StructField("volume", T.LongType()),
    ]
)

EMA_PERIODS = (20, 50, 150, 200)
EMA_FIELDS = [f"ema{period}" for period in EMA_PERIODS]
EMA_STATE_COLUMNS = ["security_id", "ticker", "as_of_date", "last_price", *EMA_FIELDS]

EMA_STATE = T.StructType(
    [
        T.StructField("security_id", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("as_of_date", T.DateType()),
        *[T.StructField(name, T.DoubleType()) for name in ["last_price", *EMA_FIELDS]],
    ]
)

MEMBER = T.StructType(
    [
        T.StructField("security_id", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("sharia_compliance", T.StringType()),
    ]
)


class ContractError(ValueError):
    """A gate refused its input; the message says which rule failed."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Return ``df`` unchanged, or raise when it lacks one of ``columns``."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{what} lacks columns: {missing}")
    return df
