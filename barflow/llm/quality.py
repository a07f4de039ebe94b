"""Quality rules with host verdicts, in DataFrame operations only.

Each document is measured inside its own row (no shuffle). Rule failures are
then counted per host with map-side aggregation; a host's failure rate is
shrunk towards all hosts with a beta prior fitted to their rates by moments;
hosts whose shrunk rate is too high reject all their documents. Only the host
table is joined back: it is written first, so Spark knows its size and
broadcasts it only where it is small, and splits a hot host otherwise.

Defined results: null text has no words and fails; a null host gets no host
verdict; repeated rows are judged each; an empty table gives no rows. Other
columns of the input travel in one struct and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.shared import SPACES, packed, require, staged

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Failure share above which a host's documents all go, after shrinking.
HOST_LIMIT = 0.8

# A host rule is a name and an SQL condition on the measures.
HOST_RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > 3 * word_chars",
    "lines": "2 * n_dup_lines > n_lines",
}

# Positions in a list ``s`` of (h, k, p), sorted, whose window k stands beside an
# equal one; then the words that 5-word windows at these positions cover.
REPEATED = """
get(transform(array(array_sort(transform(
      filter(sequence(0, size(s) - 1), j ->
        coalesce(get(s, j).h = get(s, j - 1).h AND get(s, j).k = get(s, j - 1).k, false)
        OR coalesce(get(s, j).h = get(s, j + 1).h AND get(s, j).k = get(s, j + 1).k, false)),
      j -> get(s, j).p))),
    q -> CASE WHEN size(q) = 0 THEN 0
         ELSE aggregate(sequence(0, size(q) - 1), 0, (n, j) ->
                n + CASE WHEN j = 0 THEN 5 ELSE least(5, get(q, j) - get(q, j - 1)) END) END), 0)
"""

WINDOWS = """
CASE WHEN size(toks) >= 6 THEN transform(sequence(0, size(toks) - 5), i ->
  xxhash64(get(toks, i), get(toks, i + 1), get(toks, i + 2), get(toks, i + 3), get(toks, i + 4)))
ELSE CAST(array() AS array<bigint>) END
"""

# Distinct hashes prove distinct windows. Only otherwise are windows compared as
# strings, so a chance collision costs time but never a wrong count.
REPEAT_WORDS = f"""
CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN 0L
ELSE CAST(get(transform(array(array_sort(transform(hashes, (h, i) ->
        struct(h AS h, concat_ws(' ', slice(toks, i + 1, 5)) AS k, i AS p)))), s -> {REPEATED}), 0) AS bigint) END
"""


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measured(rows: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures, ``n_lines`` and ``base_failed``; all from the whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    keep = [F.col(f"`{c}`") for c in rows.columns if c != text]
    worded = rows.select(
        *keep,
        F.filter(F.split(body, r"[ \t-\r]+"), lambda w: w != "").alias("toks"),
        (F.length(body) - _without(body, SPACES)).cast("long").alias("word_chars"),
        _without(body, SYMBOLS).cast("long").alias("n_symbols"),
        F.filter(F.split(body, "\n"), lambda line: F.rtrim(F.translate(line, SPACES, "")) != "").alias("lines"),
    )
    names = [c for c in worded.columns if c not in ("toks", "lines")]
    hashed = worded.select(
        *[F.col(f"`{c}`") for c in names],
        "toks",
        F.expr(WINDOWS).alias("hashes"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    counted = hashed.select(
        *[F.col(f"`{c}`") for c in names],
        F.size("toks").cast("long").alias("n_words"),
        "n_lines",
        "n_dup_lines",
        F.expr(REPEAT_WORDS).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Per host: documents, failures per rule and the shrunk failure rates.

    The prior of a rule has the mean m and the variance v of the hosts' rates;
    its strength is m (1 - m) / v - 1. Where hosts do not differ, every shrunk
    rate is m.
    """
    rules = rules or HOST_RULES
    sums = judged.filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.expr(sql).cast("long")).alias(f"{name}_failures") for name, sql in rules.items()],
    )
    sums = staged(sums, "hosts")
    rate = {name: F.col(f"{name}_failures") / F.col("n_docs") for name in rules}
    prior = sums.agg(
        *[F.avg(r).alias(f"{n}_mean") for n, r in rate.items()],
        *[F.var_pop(r).alias(f"{n}_var") for n, r in rate.items()],
    )
    # one row of numbers for all hosts
    fit = prior.first().asDict()
    out = sums
    for name in rules:
        mean, var = fit[f"{name}_mean"] or 0.0, fit[f"{name}_var"] or 0.0
        if var <= 0:
            shrunk = F.lit(mean)
        else:
            strength = max(mean * (1 - mean) / var - 1, 0.0)
            shrunk = (F.col(f"{name}_failures") + mean * strength) / (F.col("n_docs") + strength)
        out = out.withColumn(f"{name}_rate", shrunk)
    return out


def rejected_hosts(rates: DataFrame, rules: dict[str, str] | None = None, limit: float = HOST_LIMIT) -> DataFrame:
    over = F.lit(False)
    for name in rules or HOST_RULES:
        over = over | (F.col(f"{name}_rate") > limit)
    return rates.filter(over).select("host", F.lit(True).alias("host_rejected"))


def quality_rules(
    docs: DataFrame, host: str = "source", rules: dict[str, str] | None = None, limit: float = HOST_LIMIT
) -> DataFrame:
    """Per document ``row`` (its other columns), the measures, base_failed, host_rejected and kept."""
    require(docs, "text", host)
    rows = docs.select(packed(docs.drop("text")).alias("row"), docs[host].cast("string").alias("host"), docs["text"].alias("text"))
    return _verdicts(staged(measured(rows), "measures"), rules, limit)


def _verdicts(judged: DataFrame, rules: dict[str, str] | None, limit: float) -> DataFrame:
    bad = staged(rejected_hosts(host_rates(judged, rules), rules, limit), "bad-hosts")
    joined = judged.join(bad, "host", "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.withColumn("host_rejected", rejected).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def keep_quality(
    docs: DataFrame, host: str = "source", rules: dict[str, str] | None = None, limit: float = HOST_LIMIT
) -> DataFrame:
    """The documents that pass, with their own columns only."""
    require(docs, "text", host)
    rows = docs.select(packed(docs).alias("row"), docs[host].cast("string").alias("host"), docs["text"].alias("text"))
    judged = staged(measured(rows), "judged")
    kept = _verdicts(judged, rules, limit).filter("kept")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
