"""Tables of one bit per hashed key, of a fixed size whatever the number of keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    return (keys >> np.uint64(6)) & np.uint64(size - 1)


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """The bits of a column of 64-bit hashes; at most one row for 64 bits comes to the driver."""
    size = bits >> 6

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            bit = np.left_shift(np.uint64(1), own & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_places(own, size).astype(np.int64)), pa.array(bit)], ["at", "bit"])

    made = keys.mapInArrow(mark, "at bigint, bit bigint").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(size, np.uint64)
    out[made.column("at").to_numpy()] = made.column("bit").to_numpy().view(np.uint64)
    return out


def marked(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set: true for every key of the table, and for some others."""
    return (table[_places(keys, len(table))] >> (keys & np.uint64(63)) & np.uint64(1)).astype(bool)
