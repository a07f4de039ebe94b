"""Repair of one session in stored history that may stop at any point and be run again.

History lies in parts of securities (``part=K`` folders). A repair keeps a log
folder: the frozen plan, digests of every touched part before it, then per part
the new content (written before the part is replaced) and a marker (written
after). A run that finds new content goes on from it, since the part itself may
be half replaced; a run that finds a marker leaves the part alone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.functions.exprs import qc_issues
from barflow.operators.merge import merge_upsert_date
from barflow.schemas import BAR_COLUMNS, BARS, ContractError
from barflow.session import folder_names, path_exists

STORED = T.StructType([*BARS.fields, T.StructField("part", T.IntegerType())])


def part_of(parts: int) -> Column:
    return F.pmod(F.xxhash64("security_id"), F.lit(parts)).cast("int").alias("part")


def write_parts(bars: DataFrame, path: str, parts: int) -> None:
    """Write bars as history in ``parts`` folders of securities."""
    rows = bars.select(*BAR_COLUMNS, part_of(parts)).hint("rebalance", "part").sortWithinPartitions("part", "security_id", "date")
    rows.write.partitionBy("part").parquet(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def repair_targets(fresh: DataFrame, session: date, wanted: DataFrame | None = None) -> DataFrame:
    """Per wanted security (all of ``fresh`` where None): its fresh bar of the session and why it is refused, if so.

    ``reason`` is ``missing_source``, ``not_exactly_one_row`` or ``unsound_bar``, and NULL for a target.
    """
    rest = [c for c in BAR_COLUMNS if c != "security_id"]
    held = fresh.filter(F.col("date") == F.lit(session)).groupBy("security_id").agg(
        F.count("*").alias("fresh_rows"), F.min(F.struct(*rest)).alias("f")
    )
    ids = fresh.select("security_id").distinct() if wanted is None else wanted.select("security_id").distinct()
    bar = ids.join(held, "security_id", "left").select("security_id", "fresh_rows", *[F.col(f"f.{c}").alias(c) for c in rest])
    reason = (
        F.when(F.col("fresh_rows").isNull(), "missing_source")
        .when(F.col("fresh_rows") > 1, "not_exactly_one_row")
        .when(F.size(qc_issues()) > 0, "unsound_bar")
    )
    return bar.select(*BAR_COLUMNS, reason.alias("reason"))


def _digests(rows: DataFrame, targets: DataFrame, session: date) -> DataFrame:
    """Per part: rows and sum of hashes of all that the repair must preserve."""
    hit = targets.select("security_id", F.lit(session).alias("date"))
    rest = rows.join(hit, ["security_id", "date"], "left_anti")
    return rest.groupBy("part").agg(
        F.count("*").alias("kept_rows"), F.sum(F.xxhash64(*BAR_COLUMNS).cast("decimal(20,0)")).alias("digest")
    )


def _once(df: DataFrame, path: str) -> DataFrame:
    """Written content of ``path``; only an attempt that did not end is written again."""
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def repair_session(
    spark: SparkSession,
    path: str,
    fresh: DataFrame,
    session: date,
    log: str,
    parts: int,
    parts_per_step: int = 8,
    wanted: DataFrame | None = None,
    stop: object = None,
) -> DataFrame:
    """Set the session's bar of every target in the history at ``path``; one row per wanted security.

    ``action`` is ``added``, ``changed``, ``same`` or the refusal reason. The plan
    and what stood there before are frozen by the first run, so a resumed run
    reports and touches the same rows. Only parts with a bar to change are
    written, ``parts_per_step`` at a time. ``stop`` (tests) is called with a
    step's name and may raise. At the end every touched part must hold the rows
    it had, but for the targets, which must hold the new bars.
    """
    reach = stop or (lambda name: None)
    stored = read_parts(spark, path)
    plan = repair_targets(fresh, session, wanted).withColumn("part", part_of(parts))
    before = stored.filter(F.col("date") == F.lit(session)).select(
        "security_id", F.struct(*[F.col(c) for c in BAR_COLUMNS if c != "security_id"]).alias("before")
    )
    after = F.struct(*[F.col(c) for c in BAR_COLUMNS if c != "security_id"])
    action = (
        F.coalesce("reason", F.when(F.col("before").isNull(), "added").when(F.col("before").eqNullSafe(after), "same").otherwise("changed"))
    )
    plan = _once(plan.join(before, "security_id", "left").withColumn("action", action), f"{log}/plan")
    reach("plan")
    targets = plan.filter("action in ('added', 'changed')")
    touched = sorted(r["part"] for r in targets.select("part").distinct().collect())
    held = _once(_digests(stored.filter(F.col("part").isin(touched)), targets, session), f"{log}/before")
    reach("before")
    done = {int(n) for n in folder_names(spark, f"{log}/done")}
    for start in range(0, len(touched), parts_per_step):
        step = touched[start : start + parts_per_step]
        if step[0] in done:
            continue
        mine = F.col("part").isin(step)
        # listed anew, so that what others wrote meanwhile is not lost but fails the proof
        merged = merge_upsert_date(read_parts(spark, path).filter(mine), targets.filter(mine), session).withColumn("part", part_of(parts))
        new = _once(merged, f"{log}/new/{step[0]}")
        reach(f"new {step[0]}")
        new.hint("rebalance", "part").sortWithinPartitions("part", "security_id", "date").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("part").parquet(path)
        reach(f"replaced {step[0]}")
        new.limit(0).write.mode("overwrite").parquet(f"{log}/done/{step[0]}")
        reach(f"done {step[0]}")
    lost = preservation(read_parts(spark, path).filter(F.col("part").isin(touched)), targets, held, session)
    shown = lost.limit(5).collect()
    if shown:
        raise ContractError(f"repair changed more than its targets: {[r.asDict() for r in shown]}")
    return plan.select("security_id", "action", F.col("before.close").alias("before_close"), F.when(F.col("reason").isNull(), F.col("close")).alias("after_close"))


def preservation(rows: DataFrame, targets: DataFrame, held: DataFrame, session: date) -> DataFrame:
    """Violations: parts whose other rows differ from ``held``, and targets without exactly their new bar."""
    now = _digests(rows, targets, session).select("part", F.col("kept_rows").alias("n"), F.col("digest").alias("d"))
    parts = held.join(now, "part", "full").filter(
        ~F.col("kept_rows").eqNullSafe(F.col("n")) | ~F.col("digest").eqNullSafe(F.col("d"))
    )
    found = rows.filter(F.col("date") == F.lit(session)).groupBy("security_id").agg(
        F.count("*").alias("n"), F.min(F.xxhash64(*BAR_COLUMNS)).alias("h")
    )
    want = targets.select("security_id", F.xxhash64(*BAR_COLUMNS).alias("w"))
    unset = want.join(found, "security_id", "left").filter((F.coalesce("n", F.lit(0)) != 1) | ~F.col("w").eqNullSafe(F.col("h")))
    return parts.select(F.col("part").cast("string").alias("what"), F.lit("other_rows_changed").alias("reason")).unionByName(
        unset.select(F.col("security_id").alias("what"), F.lit("target_not_set").alias("reason"))
    )
