"""Outcome of entry signals over the bars that follow them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions.exprs import round_cents

# Bars a pending signal may wait, and an entered one may run.
PENDING_BARS = 3
HOLDING_BARS = 10
LOOKAHEAD = PENDING_BARS + HOLDING_BARS

SIGNAL_COLUMNS = [
    "signal_id", "security_id", "signal_date", "strategy", "status",
    "days_in_status", "entry_price", "stop_loss", "take_profit",
]


def _initial() -> Column:
    return F.struct(
        F.col("status").alias("status"),
        F.col("days_in_status").cast("int").alias("days"),
        F.lit(None).cast("double").alias("fill"),
        F.lit(None).cast("double").alias("exit"),
        F.lit(None).cast("string").alias("missed"),
    )


def _advance(s: Column, bar: Column, strategy: Column, entry: Column, stop: Column, target: Column) -> Column:
    """One bar of the pending -> entered -> closed life cycle; the stop wins ties."""
    o, h, lo, c = (bar.getField(n) for n in ("open", "high", "low", "close"))
    days = s.getField("days") + 1
    breakout = strategy == "breakout"
    triggered = F.when(breakout, h >= entry).otherwise(lo <= entry)
    stopped = lo <= stop
    fill = round_cents(F.when(breakout, F.greatest(o, entry)).otherwise(F.least(o, entry)))
    stop_fill = round_cents(F.least(o, stop))

    def state(status: str | Column, n: Column, filled: Column, left: Column, missed: Column) -> Column:
        return F.struct(
            (F.lit(status) if isinstance(status, str) else status).alias("status"),
            n.cast("int").alias("days"),
            filled.alias("fill"),
            left.alias("exit"),
            missed.alias("missed"),
        )

    same_fill, same_exit, same_missed = (s.getField(n) for n in ("fill", "exit", "missed"))
    zero = F.lit(0)
    pending = (
        F.when(triggered & stopped, state("sl_hit", zero, fill, F.least(stop_fill, fill), same_missed))
        .when(stopped, state("missed", days, same_fill, same_exit, F.lit("sl_hit_before_entry")))
        .when(triggered, state("entered", zero, fill, same_exit, same_missed))
        .when(days >= PENDING_BARS, state("missed", days, same_fill, same_exit, F.lit("expired")))
        .otherwise(state("pending", days, same_fill, same_exit, same_missed))
    )
    entered = (
        F.when(stopped, state("sl_hit", days, same_fill, stop_fill, same_missed))
        .when(h >= target, state("tp_hit", days, same_fill, target, same_missed))
        .when(days >= HOLDING_BARS, state("closed_timeout", days, same_fill, round_cents(c), same_missed))
        .otherwise(state("entered", days, same_fill, same_exit, same_missed))
    )
    status = s.getField("status")
    return F.when(status == "pending", pending).when(status == "entered", entered).otherwise(s)


def following_bars(dates: DataFrame, bars: DataFrame) -> DataFrame:
    """Each distinct (security_id, signal_date) with the next ``LOOKAHEAD`` bars in order.

    Bars are numbered per security and each date asks for its next numbers, so
    the match is an equi-join on (security, number), never a range join. Both
    sides of the numbering are unique per calendar date.
    """
    dates = dates.select("security_id", F.col("signal_date").alias("date")).distinct()
    bar = F.struct("open", "high", "low", "close")
    tagged = bars.select("security_id", "date", F.lit(1).alias("is_bar"), bar.alias("bar")).unionByName(
        dates.withColumn("is_bar", F.lit(0)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy("security_id")
        .orderBy(F.col("date"), F.col("is_bar").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = tagged.withColumn("seq", F.sum("is_bar").over(so_far))
    ahead = F.sequence(F.col("seq") + 1, F.col("seq") + LOOKAHEAD)
    wanted = numbered.filter(F.col("is_bar") == 0).select(
        "security_id", F.col("date").alias("signal_date"), F.explode(ahead).alias("seq")
    )
    stored = numbered.filter(F.col("is_bar") == 1).select("security_id", "seq", "bar")
    return (
        wanted.join(stored, ["security_id", "seq"])
        .groupBy("security_id", "signal_date")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "bar"))).getField("bar").alias("bars"))
    )


def signal_outcomes(signals: DataFrame, bars: DataFrame) -> DataFrame:
    """Final state of every signal after the bars that follow it."""
    ahead = following_bars(signals, bars)
    return fold_signals(signals.join(ahead, ["security_id", "signal_date"], "left"))


def fold_signals(signals: DataFrame) -> DataFrame:
    """Fold the ``bars`` array of each signal row through the life cycle."""
    step = lambda s, bar: _advance(
        s, bar, F.col("strategy"), F.col("entry_price"), F.col("stop_loss"), F.col("take_profit")
    )
    none = F.array().cast("array<struct<open:double,high:double,low:double,close:double>>")
    end = F.aggregate(F.coalesce("bars", none), _initial(), step)
    return signals.withColumn("end", end).select(
        "signal_id",
        F.col("end.status").alias("status"),
        F.col("end.days").alias("days_in_status"),
        F.col("end.fill").alias("entry_price_actual"),
        F.col("end.exit").alias("exit_price"),
        F.col("end.missed").alias("missed_reason"),
    )
