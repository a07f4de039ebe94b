"""The operators applied to their whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import bpe_codec, decontaminate, line_dedup, lm_score, quality, simhash, substring, token_count, url_filter, warc
from barflow.llm.registry import query
from barflow.llm.shared import table
from barflow.session import new_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 1024

@query("op1_simhash")
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = simhash.near_duplicates(docs)
    mark = F.lower(F.lpad(F.hex("fp0"), 16, "0"))
    return out.select("doc_id", mark.alias("fingerprint"), "component_id")


OP2_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS body FROM documents),
toks AS (
  SELECT doc_id, source, body,
    list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM t),
grams AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM toks WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice WHERE n > 1) GROUP BY doc_id),
measures AS (
  SELECT t.doc_id, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM toks t LEFT JOIN covered c ON c.doc_id = t.doc_id),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures),
hosts AS (
  SELECT source, count(*) AS n,
    count(*) FILTER (WHERE base_failed) AS k1,
    count(*) FILTER (WHERE 10 * n_symbols > 3 * word_chars) AS k2,
    count(*) FILTER (WHERE 2 * n_dup_lines > n_lines) AS k3
  FROM judged WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT avg(k1 / n) AS m1, var_pop(k1 / n) AS v1, avg(k2 / n) AS m2, var_pop(k2 / n) AS v2,
    avg(k3 / n) AS m3, var_pop(k3 / n) AS v3 FROM hosts),
strength AS (
  SELECT *, greatest(m1 * (1 - m1) / nullif(v1, 0) - 1, 0) AS s1,
    greatest(m2 * (1 - m2) / nullif(v2, 0) - 1, 0) AS s2,
    greatest(m3 * (1 - m3) / nullif(v3, 0) - 1, 0) AS s3 FROM prior),
bad AS (
  SELECT source FROM hosts, strength
  WHERE CASE WHEN v1 > 0 THEN (k1 + m1 * s1) / (n + s1) ELSE m1 END > 0.8
     OR CASE WHEN v2 > 0 THEN (k2 + m2 * s2) / (n + s2) ELSE m2 END > 0.8
     OR CASE WHEN v3 > 0 THEN (k3 + m3 * s3) / (n + s3) ELSE m3 END > 0.8)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(source NOT IN (SELECT source FROM bad), true) AS kept
FROM judged
"""


@query("op2_quality_rules", OP2_SQL)
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    judged = quality.quality_rules(docs, host="source")
    return judged.select(F.col("row.doc_id").alias("doc_id"), *quality.MEASURES, "base_failed", "kept")


OP3_SQL = r"""
WITH toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS c FROM toks),
total AS (SELECT count(*) AS t FROM words),
grams AS (
  SELECT doc_id, lag(c, 2) OVER d AS a, lag(c) OVER d AS b, c FROM words
  WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
c1 AS (SELECT c, count(*) AS n FROM grams GROUP BY c),
c2 AS (SELECT b, c, count(*) AS n FROM grams WHERE b IS NOT NULL GROUP BY b, c),
c3 AS (SELECT a, b, c, count(*) AS n FROM grams WHERE a IS NOT NULL GROUP BY a, b, c),
own AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k3, count(*) OVER (PARTITION BY doc_id, b, c) AS k2
  FROM grams),
one AS (
  SELECT own.*, c1.n / t AS s1, cb.n AS nb, c2.n AS n2, cab.n AS nab, c3.n AS n3
  FROM own JOIN c1 ON c1.c = own.c LEFT JOIN c1 cb ON cb.c = own.b
    LEFT JOIN c2 ON c2.b = own.b AND c2.c = own.c LEFT JOIN c2 cab ON cab.b = own.a AND cab.c = own.b
    LEFT JOIN c3 ON c3.a = own.a AND c3.b = own.b AND c3.c = own.c, total),
two AS (
  SELECT *, CASE WHEN b IS NULL THEN s1 WHEN n2 > k2 THEN (n2 - k2) / nb ELSE 0.4::DOUBLE * s1 END AS s2 FROM one),
terms AS (
  SELECT doc_id, floor(ln(
    CASE WHEN a IS NULL THEN s2 WHEN n3 > k3 THEN (n3 - k3) / nab ELSE 0.4::DOUBLE * s2 END) * 1e6 + 0.5) AS m
  FROM two),
sums AS (SELECT doc_id, sum(m)::BIGINT AS m FROM terms GROUP BY doc_id)
SELECT toks.doc_id, len(w)::BIGINT AS n_words, coalesce(m, 0)::BIGINT AS log_score,
  CASE WHEN len(w) > 0 THEN m / 1e6::DOUBLE / len(w) END AS score
FROM toks LEFT JOIN sums ON sums.doc_id = toks.doc_id
"""


@query("op3_lm_score", OP3_SQL)
def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Stupid-backoff score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = lm_score.backoff_scores(docs)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "log_score", "score")


OP4_SQL = r"""
WITH toks AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, md5(list_aggregate(w[i:i + 49], 'string_agg', ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM toks WHERE len(w) >= 50)),
first AS (SELECT g, min(doc_id) AS low FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first USING (g) WHERE doc_id > low),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM toks),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM toks t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""


@query("op4_substring_dedup", OP4_SQL)
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of passages that an earlier document holds, removed."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = substring.dedup_substrings(docs)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and byte-level BPE tokens of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_count.token_counts(docs, BYTE_BPE)
    over = F.col("n_tokens") > TOKEN_LIMIT
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens", over.alias("over_limit"))


OP7_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(rhost, rpath, rverdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost) * 1000 + length(rpath)) AS rule,
    arg_max(rverdict, length(rhost) * 1000 + length(rpath)) AS rverdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM parts LEFT JOIN fit USING (page_id)
"""


@query("op7_url_filter", OP7_SQL)
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.RULES_HERE)
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


@query("op9_bpe_codec")
def op9_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = bpe_codec.digests(docs, BYTE_BPE)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


OP6_SQL = r"""
WITH RECURSIVE cleaned AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM cleaned, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, p.i, p.n, item_id FROM places p JOIN windows v ON p.n = v.n AND p.g = v.g),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT c.doc_id, len(w)::BIGINT AS n_words, coalesce(v.n, 0)::BIGINT AS n_hit, coalesce(l.n, 0)::BIGINT AS n_items,
  sha256(coalesce(l.ids, '')) AS items_sha256, coalesce(v.n, 0) > 0 AS contaminated
FROM cleaned c LEFT JOIN covered v ON v.doc_id = c.doc_id LEFT JOIN listed l ON l.doc_id = c.doc_id
"""


@query("op6_decontamination", OP6_SQL)
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows that occur in each document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, l, translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS l
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
frequent AS (
  SELECT k, max(doc_id) AS last_doc FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, i, l, f.k IS NOT NULL AND doc_id <> last_doc AS gone FROM lines LEFT JOIN frequent f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op8_line_dedup", OP8_SQL)
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that many documents repeat, dropped but for the last document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM p
"""


@query("op10_warc", OP10_SQL)
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archives of all pages, written and read back."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    archive = new_folder(spark, "llm-warc")
    warc.write_warc(pages, archive)
    records = warc.read_warc(spark, archive).filter("warc_type <> 'warcinfo'")
    page = r"<urn:page:(-?\d+)>"
    digest = F.when(F.col("warc_type") == "response", F.sha1("payload")).otherwise(
        F.regexp_replace("payload_digest", "^sha1:", "")
    )
    size = F.when(F.col("warc_type") == "response", F.octet_length("payload")).otherwise(F.col("payload_bytes"))
    return records.select(
        F.nullif(F.regexp_extract("record_id", page, 1), F.lit("")).cast("long").alias("page_id"),
        size.cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.nullif(F.regexp_extract("refers_to", page, 1), F.lit("")).cast("long").alias("refers_to"),
    )
