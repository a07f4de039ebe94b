"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from barflow.schemas import ContractError

# Runtime settings every barflow plan relies on. Dates are derived from UTC
# timestamps, so the session zone is pinned; AQE sizes the shuffles, splits
# skewed join partitions and picks broadcast joins from measured sizes, which is
# why no operator carries a broadcast hint. Sides that are both dealt out by
# security meet there, also where they are joined by security and date.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "barflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, from ``spark.checkpoint.dir``.

    Only in local mode (tests on one machine), where the session names none, is
    a local temporary folder chosen and remembered for the rest of the session;
    on a cluster executors could not read it, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.barflow.folder", None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^-]*\])?", master):
            raise ContractError(f"spark.checkpoint.dir must name a shared folder on {master}")
        folder = tempfile.mkdtemp(prefix="barflow-")
        spark.conf.set("spark.barflow.folder", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts the lineage of a small frame that several branches of a plan use; the
    copy survives the loss of an executor.
    """
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, label: str) -> DataFrame:
    """Write bars below the shared folder in buckets of ``security_id`` and read them back as a table that knows them.

    Groupings, windows and joins by security, or by security and date, then run
    where the buckets lie, so bars that several of them read are shuffled once. A
    security should have about one row a date, so that none outgrows its bucket.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark, label)
    name = re.sub(r"\W", "_", os.path.basename(path))
    out = df.repartition(buckets, "security_id").write.format("parquet").option("compression", "zstd").option("path", path)
    out.bucketBy(buckets, "security_id").sortBy("security_id", "date").saveAsTable(name)
    return spark.table(name)


@contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Folders of many small files are listed and read in few tasks inside; the settings are put back after.

    By default Spark lists each folder in a task of its own, tries types on the
    names of all, and reads no more than some thirty files in a task.
    """
    inside = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.files.openCostInBytes": str(1 << 18),
    }
    before = {key: spark.conf.get(key) for key in inside}
    try:
        for key, value in inside.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is; a missing one is no error."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder of this name in whatever store it is?"""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` in whatever store it is; none where it is missing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(where):
        return []
    return [child.getPath().getName() for child in store.listStatus(where) if child.isDirectory()]


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session that was built elsewhere."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
