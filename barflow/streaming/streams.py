"""Structured Streaming forms of batch operators; each equals its batch result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.functions.keep import keep_first, keep_last
from barflow.operators.ema import SOURCE_COLUMNS, ema_advance, ema_bootstrap, extended_bootstrap
from barflow.operators.snapshots import late_verdicts, repeats_marked, verdict_rows
from barflow.schemas import BAR_KEY, BARS, EMA_FIELDS, EMA_STATE, EMA_STATE_COLUMNS
from barflow.session import clustered, folder_names, remove_folder

# Micro-batches whose folders are merged into one.
COMPACT_EVERY = 16

TICKS = T.StructType(
    [
        T.StructField("security_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def read_files_as_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def daily_bars(ticks: DataFrame) -> DataFrame:
    """Bars of one security and UTC day from ticks; stream and batch share its two steps.

    First and last tick are those with the smallest and greatest (ts, event_id).
    A tick without a time belongs to no day and is left out.
    """
    return _merged_bars(_partial_bars(ticks))


def _run(stream: DataFrame, folder: str, mode: str, per_batch) -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(per_batch)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _partial_bars(ticks: DataFrame) -> DataFrame:
    """What some ticks tell of each bar, in a form that merges with others in any order."""
    order = F.struct("ts", "event_id")
    return ticks.filter("ts is not null").groupBy("security_id", F.to_date("ts").alias("date")).agg(
        F.min_by(F.struct("ts", "event_id", "value"), order).alias("first"),
        F.max_by(F.struct("ts", "event_id", "value"), order).alias("last"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.count("*").alias("volume"),
    )


def _folded_parts(parts: DataFrame) -> DataFrame:
    """Partial bars merged into one per security and day, still in the partial form."""
    at = lambda c: F.struct(f"{c}.ts", f"{c}.event_id")
    return parts.groupBy("security_id", "date").agg(
        F.min_by("first", at("first")).alias("first"),
        F.max_by("last", at("last")).alias("last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
    )


def _merged_bars(parts: DataFrame) -> DataFrame:
    return _folded_parts(parts).select(
        "security_id", "date", F.col("first.value").alias("open"), "high", "low", F.col("last.value").alias("close"), "volume"
    )


def _read_all(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def stream_daily_bars(ticks: DataFrame, folder: str, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Run the tick stream to its end and return the bars it produced.

    No tick is too late: there is no watermark and no state that expires. Each
    micro-batch is reduced to one partial row per security and day, written to
    its own folder (overwritten as a whole, so a retried batch leaves no
    duplicate behind), and the partial rows of all batches merge into the bars.
    Every ``compact_every`` batches their folders become one, so a row is written
    twice at most and a reader opens few folders. Ticks without a time go to the
    ``undated`` table.
    """
    spark = ticks.sparkSession
    parts = _partial_bars(spark.createDataFrame([], ticks.schema)).schema

    def save(batch: DataFrame, batch_id: int) -> None:
        _partial_bars(batch).write.mode("overwrite").parquet(f"{folder}/parts/{batch_id}")
        batch.filter("ts is null").write.mode("overwrite").parquet(f"{folder}/undated/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            group = [f"{folder}/parts/{n}" for n in range(batch_id + 1 - compact_every, batch_id + 1)]
            _folded_parts(_read_all(spark, group, parts)).write.mode("overwrite").parquet(f"{folder}/folded/{batch_id}")
            # a retry of this batch still reads this group, no batch reads the one before
            for n in range(batch_id + 1 - 2 * compact_every, batch_id + 1 - compact_every):
                remove_folder(spark, f"{folder}/parts/{n}")

    _run(ticks, folder, "append", save)
    done = sorted(int(n) for n in folder_names(spark, f"{folder}/folded"))
    last = done[-1] if done else -1
    rest = [n for n in folder_names(spark, f"{folder}/parts") if int(n) > last]
    paths = [f"{folder}/folded/{n}" for n in done] + [f"{folder}/parts/{n}" for n in rest]
    return _merged_bars(_read_all(spark, paths, parts))


# EMA state as a log of changes; ``batch`` is the micro-batch that wrote a row.
_LOGGED_STATE = T.StructType([*EMA_STATE.fields, T.StructField("batch", T.LongType())])


def _newest_state(base: DataFrame, changes: DataFrame) -> DataFrame:
    """State per security: its last change, else its row of the base, which is not shuffled for a few changes."""
    last = keep_last(changes, ["security_id"], ["batch"])
    return base.join(last.select("security_id"), "security_id", "left_anti").unionByName(last)


def _logged_state(spark: SparkSession, folder: str, batch_id: int, every: int) -> tuple[DataFrame, DataFrame]:
    """Base and changes that make up the state before ``batch_id``; which base counts follows from the number alone."""
    base = batch_id // every * every - 1
    changes = [f"{folder}/changes/{n}" for n in range(base + 1, batch_id)]
    return _read_all(spark, [f"{folder}/base/{base}"], _LOGGED_STATE), _read_all(spark, changes, _LOGGED_STATE)


def _first_deliveries(delivered: DataFrame, ids: DataFrame) -> DataFrame:
    """One row (security_id, date, ticker, adj_close, n) per key of ``ids``, from the earliest delivery or history (batch -1).

    ``n`` tells how often that delivery holds the key: a key repeated within it is refused.
    """
    each = delivered.join(ids, "security_id", "left_semi").groupBy("security_id", "date", "batch").agg(
        F.max("ticker").alias("ticker"),
        F.when(F.bool_or(F.col("adj_close").isNull()), None).otherwise(F.max("adj_close")).alias("adj_close"),
        F.count("*").alias("n"),
    )
    # now as short as the calendar, so each security's rows may meet
    return keep_first(each.repartition("security_id"), ["security_id", "date"], ["batch"])


def _rebuilt_state(history: DataFrame, base: DataFrame, delivered: DataFrame, ids: DataFrame, work: str) -> DataFrame:
    """Bootstrap of ``ids`` from history and all delivered rows; of a key the earliest delivery counts.

    Securities whose deliveries are all later than their history are carried on
    from ``base``, the bootstrap of history; only the others read history again.
    """
    spark = history.sparkSession
    dated = delivered.filter("date is not null").select(*SOURCE_COLUMNS, "batch")
    first = _first_deliveries(dated, ids)
    first.write.mode("overwrite").parquet(f"{work}/first")
    first = spark.read.schema(first.schema).parquet(f"{work}/first")
    begun = first.groupBy("security_id").agg(F.min("date").alias("begun"))
    sound = (F.col("outcome") == "ok") & (F.least(*EMA_FIELDS) > 0)
    later = base.filter(sound).join(begun, "security_id").filter(F.col("begun") > F.col("as_of_date")).drop("begun")
    later.write.mode("overwrite").parquet(f"{work}/later")
    later = spark.read.schema(later.schema).parquet(f"{work}/later")
    carried = extended_bootstrap(later, first.join(later.select("security_id"), "security_id", "left_semi"))
    others = ids.join(later.select("security_id"), "security_id", "left_anti")
    if others.isEmpty():
        return carried
    past = history.select(*SOURCE_COLUMNS, F.lit(-1).cast("long").alias("batch"))
    whole = _first_deliveries(past.unionByName(dated), others)
    shown = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(2).cast("long")).cast("int")))
    return carried.unionByName(ema_bootstrap(whole.select(*SOURCE_COLUMNS, shown.alias("copy")).drop("copy")))


def stream_ema(
    bars: DataFrame,
    initial_state: DataFrame,
    folder: str,
    history: DataFrame | None = None,
    compact_every: int = COMPACT_EVERY,
) -> DataFrame:
    """Carry EMA state over a stream of bars; returns the final state.

    State is keyed by security and kept as a log: a batch reads the rows of the
    securities it delivers and writes those that it changed; every
    ``compact_every`` batches base and changes become a new base.

    Bars not newer than the state (``late``), without a date (``no_date``) or of a
    security without state (``unknown_security``) go to the ``side`` table.
    Without ``history`` they change nothing. With it (the bars behind the initial
    state) their securities, and those whose state cannot be carried on, are
    rebuilt from history and everything delivered, so deliveries may come in any
    order; of a key delivered twice the first counts. History is folded once, at
    the first rebuild, and read again only for securities with deliveries that are
    not later than it or that have no sound state from it. A security whose rebuild
    fails, or whose new bars are unusable, keeps its state and is listed in
    ``held`` with the reason.
    """
    spark = bars.sparkSession
    # a resumed run has a base already; the first batch must find one
    if not folder_names(spark, f"{folder}/changes"):
        start = initial_state.select(*EMA_STATE_COLUMNS, F.lit(-1).cast("long").alias("batch"))
        start.write.mode("overwrite").parquet(f"{folder}/base/-1")
    folded: list[DataFrame] = []

    def history_state() -> DataFrame:
        """Bootstrap of history, written at the first rebuild of this run."""
        if not folded:
            whole = ema_bootstrap(history)
            whole.write.mode("overwrite").parquet(f"{folder}/history-state")
            folded.append(spark.read.schema(whole.schema).parquet(f"{folder}/history-state"))
        return folded[0]

    delivered_schema = T.StructType([*bars.schema.fields, T.StructField("batch", T.LongType())])

    def save(batch: DataFrame, batch_id: int) -> None:
        work = f"{folder}/work/{batch_id}"

        def written(df: DataFrame, path: str) -> DataFrame:
            df.write.mode("overwrite").parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        rows = written(batch, f"{folder}/rows/batch={batch_id}")
        ids = rows.select("security_id").distinct()
        base, changes = _logged_state(spark, folder, batch_id, compact_every)
        touched = lambda df: df.join(ids, "security_id", "left_semi")
        state = written(_newest_state(touched(base), touched(changes)).select(*EMA_STATE_COLUMNS), f"{work}/state")
        side = (
            F.when(F.col("as_of_date").isNull(), "unknown_security")
            .when(F.col("date").isNull(), "no_date")
            .when(F.col("date") <= F.col("as_of_date"), "late")
        )
        labelled = rows.join(state.select("security_id", "as_of_date"), "security_id", "left").withColumn("side", side)
        labelled = written(labelled.drop("as_of_date"), f"{work}/labelled")
        labelled.filter("side is not null").write.mode("overwrite").parquet(f"{folder}/side/batch={batch_id}")

        fresh = labelled.filter("side is null").select(*SOURCE_COLUMNS)
        prior = state.join(fresh.select("security_id").distinct(), "security_id", "left_semi")
        anchors = prior.select(
            F.col("as_of_date").alias("date"), "security_id", "ticker", F.col("last_price").alias("adj_close")
        )
        moved = written(ema_advance(prior, fresh.unionByName(anchors)), f"{work}/moved")
        good = moved.filter(~F.col("needs_rebuild")).select(*EMA_STATE_COLUMNS)
        held = moved.filter("needs_rebuild").select("security_id", "reason")
        if history is not None:
            odd = labelled.filter("side in ('late', 'unknown_security') and date is not null").select("security_id")
            redo = written(odd.unionByName(held.select("security_id")).distinct(), f"{work}/redo")
            # history is not read where nothing came out of order
            if not redo.isEmpty():
                past = spark.read.schema(delivered_schema).option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
                rebuilt = written(_rebuilt_state(history, history_state(), past, redo, work), f"{work}/rebuilt")
                held = rebuilt.filter("outcome <> 'ok'").select("security_id", F.col("outcome").alias("reason"))
                good = good.join(redo, "security_id", "left_anti").unionByName(
                    rebuilt.filter("outcome = 'ok'").select(*EMA_STATE_COLUMNS)
                )
        held.write.mode("overwrite").parquet(f"{folder}/held/batch={batch_id}")
        changed = good.withColumn("batch", F.lit(batch_id).cast("long"))
        changed.write.mode("overwrite").parquet(f"{folder}/changes/{batch_id}")
        if (batch_id + 1) % compact_every == 0:
            new = _read_all(spark, [f"{folder}/changes/{batch_id}"], _LOGGED_STATE)
            whole = _newest_state(base, changes.unionByName(new))
            whole.write.mode("overwrite").parquet(f"{folder}/base/{batch_id}")
            # a retry of this batch reads the base before it; older ones are of no use
            remove_folder(spark, f"{folder}/base/{batch_id - 2 * compact_every}")
            for n in range(batch_id + 1 - 2 * compact_every, batch_id + 1 - compact_every):
                remove_folder(spark, f"{folder}/changes/{n}")
        remove_folder(spark, work)

    _run(bars, folder, "append", save)
    ran = [int(n) for n in folder_names(spark, f"{folder}/changes")]
    base, changes = _logged_state(spark, folder, max(ran, default=-1) + 1, compact_every)
    return _newest_state(base, changes).select(*EMA_STATE_COLUMNS)


def stream_finalize(bars: DataFrame, folder: str, cutoff: date, published: date | None = None) -> DataFrame:
    """Split a bar stream into ``final``, ``late`` (already published) and ``not_final`` rows.

    Row-wise, so nothing is shuffled and no state is kept; returns the rows with
    their ``stream_class``.
    """
    day = F.col("date")
    late = day <= F.lit(published) if published is not None else F.lit(False)
    label = F.when(day > F.lit(cutoff), "not_final").when(late, "late").otherwise("final")
    query = (
        bars.withColumn("stream_class", label)
        .writeStream.format("parquet")
        .partitionBy("stream_class")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = T.StructType([*BARS.fields, T.StructField("stream_class", T.StringType())])
    return bars.sparkSession.read.schema(schema).parquet(f"{folder}/rows")


def stream_late_arrivals(bars: DataFrame, epochs: dict[date, DataFrame], folder: str, window: int) -> DataFrame:
    """Bars that arrive after the snapshots they belong to, per snapshot with its reason; see ``late_arrivals``.

    ``epochs`` are the published snapshots by their date, some few that are still
    in use; they are written once, clustered by security. Rows newer than all of
    them pass. A batch shuffles its own rows once for all snapshots and asks of
    the earlier ones for their keys only, so a key delivered again is found
    whatever batch brought it first; the side table, a row of which holds a bar's
    verdicts for all snapshots, equals ``late_arrivals`` of all deliveries at once.
    """
    spark = bars.sparkSession
    last = max(epochs)
    held = {as_of: clustered(epoch, "epoch") for as_of, epoch in epochs.items()}
    # Spark itself names the columns of the side table, also where nothing arrives
    none = spark.createDataFrame([], T.StructType([*BARS.fields, T.StructField("delivery", T.LongType())]))
    judged = late_verdicts(repeats_marked(none), held, window).schema

    def side(before: int | None = None) -> DataFrame:
        batches = [int(n) for n in folder_names(spark, f"{folder}/late")]
        return _read_all(spark, [f"{folder}/late/{n}" for n in batches if before is None or n < before], judged)

    def save(batch: DataFrame, batch_id: int) -> None:
        late = batch.filter(F.col("date") <= F.lit(last)).select(*BARS.fieldNames(), F.lit(batch_id).cast("long").alias("delivery"))
        rows = repeats_marked(late)
        if batch_id:
            seen = side(batch_id).select(*BAR_KEY).repartition("security_id").distinct().withColumn("seen", F.lit(True))
            rows = rows.join(seen, BAR_KEY, "left").withColumn("repeated", F.col("repeated") | F.col("seen").isNotNull()).drop("seen")
        found = late_verdicts(rows, held, window)
        found.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/late/{batch_id}")

    _run(bars, folder, "append", save)
    return verdict_rows(side())
