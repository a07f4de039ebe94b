"""Readers for landed files. Checks are aggregates; nothing is listed on the driver."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.functions import exprs as X
from barflow.functions.keep import keep_last
from barflow.operators.merge import raise_on_rows
from barflow.operators.universe import deferred_issues, eligible, review_registry_issues
from barflow.schemas import BAR_COLUMNS, BARS, MEMBER, ContractError, require_columns
from barflow.session import clustered, many_small_files, materialize


def read_bars(spark: SparkSession, path: str, security_ids: DataFrame | None = None) -> DataFrame:
    """Stored bars with valid dates; the nine columns are required, others are not read."""
    df = require_columns(spark.read.parquet(path), BAR_COLUMNS, path)
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in BARS.fields])
    bars = typed.filter(F.col("date").isNotNull())
    if security_ids is None:
        return bars
    return bars.join(security_ids.select("security_id"), "security_id", "left_semi")


MEMBERSHIP_DOCUMENT = T.StructType(
    [
        T.StructField("snapshot_date", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("records", T.ArrayType(MEMBER)),
    ]
)


def membership_documents(
    spark: SparkSession, path: str, record: T.StructType = MEMBER, multi_line: bool = True
) -> DataFrame:
    """One row per membership document; a folder of documents is read in parallel.

    ``multi_line`` reads one document per file, otherwise one per line, which
    also splits large files.
    """
    schema = T.StructType(
        [*MEMBERSHIP_DOCUMENT.fields[:2], T.StructField("records", T.ArrayType(record))]
    )
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def membership_issues(documents: DataFrame, need_ticker: bool = True) -> DataFrame:
    """Per document: count mismatch, records without identity, repeated ids."""
    size = F.coalesce(F.size("records"), F.lit(-1))
    shape = documents.filter(~F.col("count").eqNullSafe(size)).select(
        "snapshot_date", F.lit("count_mismatch").alias("issue")
    )
    rows = documents.select("snapshot_date", F.explode("records").alias("r"))
    blank = lambda c: F.coalesce(F.trim(F.col(f"r.{c}")), F.lit("")) == ""
    unnamed = blank("security_id") | (blank("ticker") if need_ticker else F.lit(False))
    nameless = rows.filter(unnamed).select("snapshot_date", F.lit("missing_identity").alias("issue")).distinct()
    repeated = (
        rows.groupBy("snapshot_date", "r.security_id")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .select("snapshot_date", F.lit("duplicate_security_id").alias("issue"))
        .distinct()
    )
    return shape.unionByName(nameless).unionByName(repeated)


def read_membership(
    spark: SparkSession,
    path: str,
    snapshot: str | None = None,
    only_eligible: bool = True,
    record: T.StructType = MEMBER,
    multi_line: bool = True,
) -> DataFrame:
    """Members of the snapshot document(s) at ``path``; raises when a document is unsound."""
    docs = membership_documents(spark, path, record, multi_line)
    need_ticker = "ticker" in record.fieldNames()
    raise_on_rows(membership_issues(docs, need_ticker), "membership rejected")
    if snapshot is not None:
        other = docs.filter(~F.col("snapshot_date").eqNullSafe(F.lit(snapshot))).select("snapshot_date")
        raise_on_rows(other, f"membership is not of snapshot {snapshot}")
    members = docs.select("snapshot_date", F.explode("records").alias("r")).select("snapshot_date", "r.*")
    return eligible(members) if only_eligible else members


# The trailer of a symbol directory file and the provenance labels.
DIRECTORY_TRAILER = "File Creation Time"
DIRECTORY_PROVIDER = "NASDAQ_TRADER_SYMBOL_DIRECTORY"
DIRECTORY_FILES = ("nasdaqlisted.txt", "otherlisted.txt")


def _pipe_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "|").option("header", "true").csv(path)


def directory_issues(raw: DataFrame, source_file: str) -> DataFrame:
    """A directory file needs exactly one trailer row and at least one security row."""
    first = F.col(f"`{raw.columns[0]}`")
    trailer = F.coalesce(first.startswith(DIRECTORY_TRAILER), F.lit(False))
    facts = raw.agg(F.count_if(trailer).alias("trailers"), F.count_if(~trailer).alias("rows"))
    issue = F.when(F.col("trailers") != 1, "expected_one_trailer").when(F.col("rows") == 0, "no_security_rows")
    return facts.select(F.lit(source_file).alias("source_file"), issue.alias("issue")).filter(
        F.col("issue").isNotNull()
    )


def read_symbol_directory(
    spark: SparkSession, listed_path: str, other_path: str, fetched_at: str, contract_version: str
) -> DataFrame:
    """Both directory layouts as one table. ETF and test flags are kept, not filtered."""
    listed, other = _pipe_file(spark, listed_path), _pipe_file(spark, other_path)
    issues = directory_issues(listed, DIRECTORY_FILES[0]).unionByName(
        directory_issues(other, DIRECTORY_FILES[1])
    )
    raise_on_rows(issues, "symbol directory rejected")
    out = directory_rows(listed, other).withColumns(
        {
            "source_provider": F.lit(DIRECTORY_PROVIDER),
            "source_contract_version": F.lit(contract_version),
            "fetched_at": F.lit(fetched_at),
        }
    )
    repeated = out.groupBy("source_file", "symbol").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    raise_on_rows(repeated, "duplicate symbol within a source file")
    if out.isEmpty():
        raise ContractError("symbol directory is empty")
    return out


def directory_rows(listed: DataFrame, other: DataFrame) -> DataFrame:
    def column(df: DataFrame, name: str) -> Column:
        return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")

    def shape(df: DataFrame, symbol: str, exchange: Column, source: str, category: str, status: str) -> DataFrame:
        first = F.col(f"`{df.columns[0]}`")
        body = df.filter(~F.coalesce(first.startswith(DIRECTORY_TRAILER), F.lit(False)))
        return body.select(
            F.trim(column(df, symbol)).alias("symbol"),
            F.trim(column(df, "Security Name")).alias("security_name"),
            exchange.alias("listing_exchange"),
            column(df, category).alias("market_category"),
            column(df, status).alias("financial_status"),
            column(df, "ETF").alias("is_etf"),
            column(df, "Test Issue").alias("test_issue"),
            F.lit(source).alias("source_file"),
        ).filter(F.coalesce("symbol", F.lit("")) != "")

    other_symbol = "ACT Symbol" if "ACT Symbol" in other.columns else other.columns[0]
    a = shape(listed, "Symbol", F.lit("NASDAQ"), DIRECTORY_FILES[0], "Market Category", "Financial Status")
    b = shape(other, other_symbol, F.trim(column(other, "Exchange")), DIRECTORY_FILES[1], "-", "-")
    return a.unionByName(b)


def file_label(path_parts: int = 1) -> Column:
    """The last ``path_parts`` parts of the path a row was read from."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    return F.array_join(F.slice(parts, -path_parts, path_parts), "/")


# Files of at most so many bytes are read whole, one row each. Longer ones are read line by line, as are those whose
# ending may name a codec, which the reader of lines knows.
WHOLE_FILE = 4 << 20
PACKED = r"(?i)\.(bz2|deflate|gz|lz4|lzo|snappy|xz|z|zst|zstd)$"


def _names(line: Column) -> Column:
    """Cells of a line as column names."""
    return F.transform(F.split(line, ","), lambda c: F.upper(F.trim(F.translate(c, "<>", ""))))


def _may_name(line: Column, column: str) -> Column:
    """False for nearly all lines that do not name the column, at little cost."""
    return F.contains(F.upper(line), F.lit(column)) | F.contains(line, F.lit("<")) | F.contains(line, F.lit(">"))


def _not_blank(line: Column) -> Column:
    return line.rlike("[^ ,]")


def _lacking(needed: list[str]) -> Column:
    return F.array_except(F.array(*map(F.lit, needed)), F.coalesce("header", F.array().cast("array<string>")))


def _whole_files(files: DataFrame, needed: list[str], listed: DataFrame) -> DataFrame:
    """Lines of files (filename, text), a row each with its file's header; of a file that lacks columns one row, ``lacks`` them."""
    first = needed[0]
    lines = F.when(F.contains("text", F.lit("\r")), F.split("text", "\r\n|\r|\n")).otherwise(F.split("text", "\n"))
    heads = F.filter(F.transform(F.filter(lines, lambda x: _may_name(x, first)), _names), lambda n: F.array_contains(n, first))
    headed = files.filter(F.col("text") != "").withColumn("header", F.array_max(heads))
    headed = headed.withColumn("lacks", F.when(F.size(_lacking(needed)) > 0, _lacking(needed)))
    placed = headed.join(listed.withColumn("held", F.lit(True)), "filename", "left").filter("held OR lacks IS NOT NULL")
    rows = placed.withColumn("value", F.explode(F.when(F.col("lacks").isNull(), lines).otherwise(F.array(F.lit("")))))
    head = F.when(_may_name(F.col("value"), first), F.array_contains(_names(F.col("value")), first)).otherwise(False)
    body = ~head & _not_blank(F.col("value"))
    order = F.struct(F.lit(-1).cast("long").alias("block"), F.monotonically_increasing_id().alias("id"))
    return rows.filter(body | F.col("lacks").isNotNull()).withColumn("src_ord", order).drop("text", "held")


def _long_files(lines: DataFrame, needed: list[str], listed: DataFrame) -> DataFrame:
    """The same of files given as lines (filename, block, value); raises when one lacks columns."""
    first = needed[0]
    names, order = _names(F.col("value")), F.struct("block", F.monotonically_increasing_id().alias("id"))
    lines = lines.withColumns({"names": F.when(F.array_contains(names, first), names), "src_ord": order}).drop("block")
    lines = materialize(lines, "archive-lines")
    # one short row per file
    headers = materialize(lines.groupBy("filename").agg(F.max("names").alias("header")), "archive-headers")
    _raise_on_lacking(headers.withColumn("lacks", _lacking(needed)).filter(F.size("lacks") > 0))
    body = lines.filter(F.col("names").isNull() & _not_blank(F.col("value"))).drop("names")
    return body.join(headers.join(listed, "filename"), "filename").withColumn("lacks", F.lit(None).cast("array<string>"))


def _raise_on_lacking(files: DataFrame) -> None:
    raise_on_rows(files.select("filename", "lacks").distinct(), "bulk archive lacks columns")


def _rows_by_own_header(spark: SparkSession, path: str, path_parts: int, needed: list[str], listed: DataFrame) -> DataFrame:
    """Rows of the ``listed`` comma-separated files, whose column orders may differ: each value under its own file's header.

    A header is the line that names the first needed column; names are compared
    without case, blanks and angle brackets. A file that lacks a column has one
    row, whose ``lacks`` names them. Files may be many and small: those of up to
    ``WHOLE_FILE`` bytes meet their manifest rows and headers as one row each.
    """
    whole = (F.col("_metadata.file_size") <= WHOLE_FILE) & ~F.col("_metadata.file_name").rlike(PACKED)
    name, block = file_label(path_parts).alias("filename"), F.col("_metadata.file_block_start").alias("block")
    files = spark.read.format("binaryFile").load(path)
    text = F.col("content").cast("string")
    # as the reader of lines does, without a byte order mark
    text = F.when(F.startswith(text, F.lit("\ufeff")), F.substring(text, 2, WHOLE_FILE)).otherwise(text)
    rows = _whole_files(files.filter(whole).select(name, text.alias("text")), needed, listed)
    if not files.filter(~whole).select("length").isEmpty():
        lines = spark.read.text(path).filter(~whole).select(name, block, "value")
        rows = rows.unionByName(_long_files(lines, needed, listed))
    rows = rows.withColumn("cells", F.split("value", ","))
    cell = lambda c: F.trim(F.get("cells", (F.array_position("header", c) - 1).cast("int")))
    return rows.select(*[cell(c).alias(c) for c in needed], *listed.columns, "lacks", "src_ord")


def read_bulk_archive(
    spark: SparkSession, path: str, manifest: DataFrame, path_parts: int = 1
) -> DataFrame:
    """Bulk price files of the securities a manifest lists as COPIED, with ``verdict``.

    ``manifest``: security_id, ticker, status, filename, where filename is the
    last ``path_parts`` parts of the file's path. Adjusted close is the close. One bad row rejects its security; a listed security without any row is
    reported as ``missing_file``.
    """
    needed = ["DATE", "OPEN", "HIGH", "LOW", "CLOSE", "VOL"]
    listed = manifest.filter(F.upper("status") == "COPIED").select("security_id", "ticker", "filename")
    number = lambda c: F.col(c).try_cast("double")
    columns = [
        F.try_to_date("DATE", "yyyyMMdd").alias("date"),
        "security_id",
        "ticker",
        *[number(c.upper()).alias(c) for c in ("open", "high", "low", "close")],
        number("CLOSE").alias("adj_close"),
        number("VOL").try_cast("long").alias("volume"),
        "src_ord",
        "filename",
        "lacks",
    ]
    with many_small_files(spark):
        rows = clustered(_rows_by_own_header(spark, path, path_parts, needed, listed).select(*columns), "archive-rows")
    _raise_on_lacking(rows.filter(F.col("lacks").isNotNull()))
    rows = rows.filter(F.col("lacks").isNull()).drop("filename", "lacks")
    absent = F.lit(False)
    for c in BAR_COLUMNS[3:]:
        absent = absent | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    broken = rows.groupBy("security_id").agg(
        F.bool_or(F.col("date").isNull()).alias("no_date"), F.bool_or(absent).alias("absent")
    )
    last = keep_last(rows.filter(F.col("date").isNotNull()), ["security_id", "date"], ["src_ord"])
    per_security = Window.partitionBy("security_id")
    judged = last.withColumn("bad", F.max(~X.is_sound()).over(per_security))
    verdict = (
        F.when(F.col("no_date").isNull(), "missing_file")
        .when(F.col("no_date"), "invalid_date")
        .when(F.col("absent"), "null_or_non_numeric")
        .when(F.col("bad"), "qc_rejected")
        .otherwise("staged")
    )
    return (
        listed.select("security_id", F.col("ticker").alias("listed_ticker"))
        .join(broken, "security_id", "left")
        .join(judged.drop("ticker", "src_ord"), "security_id", "left")
        .withColumnRenamed("listed_ticker", "ticker")
        .select(*BAR_COLUMNS, verdict.alias("verdict"))
    )


PROVIDER_NAMES = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}


def unpivot_provider(wide: DataFrame, date_col: str = "Date", sep: str = "|") -> DataFrame:
    """Wide ``symbol|field`` (or ``field|symbol``) columns as one row per symbol and date.

    Rows in which a symbol has no value at all are dropped.
    """
    cells = [c for c in wide.columns if c != date_col and sep in c]
    if not cells:
        raise ContractError("provider frame has no symbol|field columns")
    long = wide.select(date_col, *[F.col(f"`{c}`").try_cast("double").alias(c) for c in cells]).unpivot(
        [date_col], [f"`{c}`" for c in cells], "cell", "value"
    )
    left = F.split_part("cell", F.lit(sep), F.lit(1))
    right = F.split_part("cell", F.lit(sep), F.lit(2))
    field_first = left.isin(*PROVIDER_NAMES)
    named = long.filter(F.col("value").isNotNull() & ~F.isnan("value")).select(
        F.when(field_first, right).otherwise(left).alias("symbol"),
        F.when(field_first, left).otherwise(right).alias("field"),
        F.col(date_col).try_cast("date").alias("date"),
        "value",
    )
    return (
        named.groupBy("symbol", "date")
        .pivot("field", list(PROVIDER_NAMES))
        .agg(F.max("value"))
        .select("symbol", "date", *[F.col(f"`{k}`").alias(v) for k, v in PROVIDER_NAMES.items()])
    )


_TEXT_BAR = "datetime:string,open:string,high:string,low:string,close:string,volume:string"
PROVIDER_LAYOUTS = {
    "values": f"status string, code string, meta struct<symbol:string>, values array<struct<{_TEXT_BAR}>>",
    "list": "array<struct<date:string,open:string,high:string,low:string,close:string,"
    "volume:string,adjClose:string>>",
    "map": "struct<bars:map<string,array<struct<t:string,o:string,h:string,l:string,c:string,v:string>>>>",
}


def parse_provider_json(landed: DataFrame, layout: str) -> DataFrame:
    """Landed provider payloads (``symbol``, ``payload``) as typed bars with verdicts.

    ``verdict`` is judged per symbol: ``response_error``, ``identity_mismatch``,
    ``qc_rejected``, ``duplicate_dates``, ``empty`` or ``accepted``.
    """
    if layout not in PROVIDER_LAYOUTS:
        raise ValueError(f"layout must be one of {sorted(PROVIDER_LAYOUTS)}")
    # from_json wraps a lone object where an array is expected, so look at the text
    is_list = F.coalesce(F.ltrim("payload").startswith("["), F.lit(False))
    doc = landed.select(
        "symbol", is_list.alias("is_list"), F.from_json("payload", PROVIDER_LAYOUTS[layout]).alias("d")
    )
    if layout == "values":
        failed = (F.col("d.status") == "error") | F.col("d.values").isNull()
        alien = ~F.upper("d.meta.symbol").eqNullSafe(F.upper("symbol"))
        bars = doc.select(
            "symbol",
            F.coalesce(failed, F.lit(True)).alias("failed"),
            alien.alias("alien"),
            F.explode_outer("d.values").alias("b"),
        )
        day, names, adj = "b.datetime", {c: f"b.{c}" for c in X.PROVIDER_FIELDS}, None
    elif layout == "list":
        bars = doc.select(
            "symbol",
            (F.col("d").isNull() | ~F.col("is_list")).alias("failed"),
            F.lit(False).alias("alien"),
            F.explode_outer("d").alias("b"),
        )
        day, names, adj = "b.date", {c: f"b.{c}" for c in X.PROVIDER_FIELDS}, "b.adjClose"
    else:
        # a payload without any symbol of its own answers for the symbol it was landed under
        per_symbol = doc.select("symbol", F.col("d.bars").isNull().alias("failed"), F.explode_outer("d.bars").alias("named", "list"))
        bars = per_symbol.select(
            F.coalesce("named", "symbol").alias("symbol"), "failed", F.lit(False).alias("alien"), F.explode_outer("list").alias("b")
        )
        names = dict(zip(X.PROVIDER_FIELDS, ("b.o", "b.h", "b.l", "b.c", "b.v")))
        day, adj = "b.t", None
    typed = bars.select(
        "symbol",
        "failed",
        "alien",
        X.leading_date(day).alias("date"),
        *[F.col(path).try_cast("double").alias(c) for c, path in names.items()],
        (F.col(adj).try_cast("double") if adj else F.lit(None).cast("double")).alias("adj_close"),
        F.col("b").isNotNull().alias("has_bar"),
    )
    # a date repeated any number of times becomes one row before the symbol is judged
    per_date = typed.groupBy("symbol", "date").agg(
        F.bool_or("failed").alias("failed"),
        F.bool_or("alien").alias("alien"),
        F.count_if("has_bar").alias("n"),
        F.bool_or(F.col("has_bar") & ~X.is_sound(X.qc_issues_no_adj())).alias("bad"),
        F.min_by(F.struct(*X.PROVIDER_FIELDS, "adj_close"), F.coalesce("close", F.lit(0.0))).alias("v"),
    )
    w = Window.partitionBy("symbol")
    flag = lambda c: F.max(c).over(w)
    verdict = (
        F.when(flag(F.col("failed")), "response_error")
        .when(flag(F.col("alien")), "identity_mismatch")
        .when(F.sum("n").over(w) == 0, "empty")
        .when(flag(F.col("bad") | (F.col("date").isNull() & (F.col("n") > 0))), "qc_rejected")
        .when(flag(F.col("n")) > 1, "duplicate_dates")
        .otherwise("accepted")
    )
    return per_date.withColumn("verdict", verdict).select(
        "symbol", "date", *[F.col(f"v.{c}").alias(c) for c in (*X.PROVIDER_FIELDS, "adj_close")], "verdict"
    )


RUN_MANIFEST = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(c, T.StringType())
                        for c in ("security_id", "ticker", "symbol", "status", "error")
                    ]
                )
            ),
        )
    ]
)


def manifest_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Result rows of all run manifests in a folder, with the manifest's file name.

    ``multi_line`` reads one document per file, otherwise one per line, which
    also splits large files.
    """
    docs = spark.read.schema(RUN_MANIFEST).option("multiLine", multi_line).json(path)
    return docs.select(
        F.col("_metadata.file_name").alias("manifest_key"), F.posexplode("results").alias("pos", "r")
    ).select("manifest_key", "pos", "r.*").filter(F.coalesce("security_id", F.lit("")) != "")


def latest_failure_log(results: DataFrame, repair_prefix: str = "repair-run-") -> DataFrame:
    """Per security: its last recorded failure and whether a repair run gave it up."""
    failed = F.col("status") == "failed"
    lasting = (F.col("status") == "still_unavailable") & F.col("manifest_key").startswith(repair_prefix)
    out = results.groupBy("security_id").agg(
        F.max_by(
            F.struct("ticker", "symbol", "error", "manifest_key"),
            F.when(failed, F.struct("manifest_key", "pos")),
        ).alias("f"),
        F.bool_or(lasting).alias("still_unavailable"),
        F.count_if(failed).alias("failures"),
    )
    return out.filter((F.col("failures") > 0) | F.col("still_unavailable")).select(
        "security_id",
        F.col("f.ticker").alias("ticker"),
        F.col("f.symbol").alias("symbol"),
        F.col("f.error").alias("error"),
        F.col("f.manifest_key").alias("manifest_key"),
        "still_unavailable",
        "failures",
    )


def _text_fields(*names: str, dates: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, T.DateType() if n in dates else T.StringType()) for n in names])


LIFECYCLE = _text_fields(
    "security_id", "ticker", "lifecycle_status", "effective_date", "reason", "successor_security_id",
    "successor_ticker", dates=("effective_date",),
)
CANDIDATE = _text_fields("security_id", "ticker")
DEFERRED = _text_fields("security_id", "ticker", "reason", "event_date", "detail", "source", "reviewed_at")
REVIEW = _text_fields(
    "security_id", "ticker", "scope", "snapshot_date", "reviewed_at", "finding", "detail", "source_url", "event_date",
    "resolution",
)
QUARANTINE = _text_fields("ready_as_of_date", "ready_sha256", "last_known_good_as_of_date", "reason")


def read_records(
    spark: SparkSession, path: str, field: str, record: T.StructType, version: int | None = None, multi_line: bool = True
) -> DataFrame:
    """Rows of the array ``field`` of registry documents; the array must be there.

    With ``version`` the document's schema_version must equal it; for
    ``multi_line`` see :func:`manifest_results`.
    """
    schema = T.StructType(
        [T.StructField("schema_version", T.IntegerType()), T.StructField(field, T.ArrayType(record))]
    )
    docs = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    bad = F.col(field).isNull()
    if version is not None:
        bad = bad | ~F.col("schema_version").eqNullSafe(F.lit(version))
    raise_on_rows(docs.filter(bad).select("schema_version"), f"document without usable {field}")
    return docs.select(F.explode(field).alias("r")).select("r.*")


def _unique_ids(rows: DataFrame, what: str) -> DataFrame:
    raise_on_rows(deferred_issues(rows).select("security_id", "issue"), f"{what} rejected")
    return rows


def read_lifecycle_registry(spark: SparkSession, path: str) -> DataFrame:
    """Lifecycle records; ids must be present and unique."""
    return _unique_ids(read_records(spark, path, "records", LIFECYCLE, 1), "lifecycle registry")


def read_onboarding_plan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(candidates, deferred) of a reviewed onboarding plan; deferred ids must be present and unique."""
    deferred = _unique_ids(read_records(spark, path, "deferred", DEFERRED), "deferred list")
    return read_records(spark, path, "candidates", CANDIDATE), deferred


def read_review_registry(spark: SparkSession, path: str) -> DataFrame:
    """Recorded reviews; raises when a record may not be used."""
    rows = read_records(spark, path, "records", REVIEW, 1)
    raise_on_rows(review_registry_issues(rows), "review registry rejected")
    return rows


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Known-bad snapshots in the form :func:`trusted_predecessor` takes."""
    return read_records(spark, path, "quarantined_ready", QUARANTINE).select(
        F.col("ready_as_of_date").alias("as_of_date"),
        F.col("ready_sha256").alias("fingerprint"),
        F.col("last_known_good_as_of_date").alias("last_known_good"),
    )


def incremental_start(last_date: date | Column, overlap_days: int = 7) -> Column:
    """First date an incremental fetch asks for: the last stored date minus an overlap."""
    day = F.lit(last_date) if isinstance(last_date, date) else last_date
    return F.date_sub(day, overlap_days)
