"""Helpers that several operators use."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.session import new_folder, remove_folder

# The ASCII space characters that end a word.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that they cannot clash with an operator's own."""
    return F.struct(*[docs[c] for c in docs.columns])


# Folders staged since a pipeline stage began, by the session's application.
_OPEN: dict[str, list[str]] = {}
# Those of the stage before, to be deleted when the next begins.
_DONE: dict[str, list[str]] = {}


def staged(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write below the shared folder and read back; survives a lost executor."""
    spark = df.sparkSession
    path = new_folder(spark, f"llm-{label}")
    df.write.option("compression", codec).parquet(path)
    app = spark.sparkContext.applicationId
    if app in _OPEN:
        _OPEN[app].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing yet to run reads; what was made of them must have been written."""
    for df in tables:
        remove_folder(df.sparkSession, df.staged_at)


@contextmanager
def stage_of_pipeline(spark: SparkSession) -> Iterator[None]:
    """Staged tables made inside belong to one pipeline stage.

    A stage's result is written and read again before the next stage begins, so
    what the one before has staged is deleted then. Tables staged outside of
    pipeline stages are left alone.
    """
    app = spark.sparkContext.applicationId
    for path in _DONE.pop(app, []):
        remove_folder(spark, path)
    _OPEN[app] = []
    try:
        yield
    finally:
        _DONE[app] = _OPEN.pop(app)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Tables written inside leave no shuffle files behind; the setting is put back after."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def utf8(name: str) -> Column:
    """Text as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


# Rows and bytes of an Arrow batch. Batches of the default 10,000 texts are
# copied several times on both sides of the pipe and take most of a worker's memory.
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20


def require(docs: DataFrame, *names: str) -> None:
    """Check the columns, and keep the session's batches of texts small."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    missing = [n for n in names if n not in docs.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
