"""The learned operators, phrases and vector codes applied to their whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import phrases, quality_model, vector_codes
from barflow.llm.registry import query
from barflow.llm.shared import staged, table
from barflow.llm.vector_codes import ENTRIES, PARTS, ROUNDS


@query("op11_quality_classifier")
def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Probability that a document is of good quality, and the verdict."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = quality_model.classified(docs, table(spark, folder, "labels"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted")


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM pieces, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
phrases AS (SELECT lang, k, g, a, string_split(g, ' ') AS w FROM counts WHERE a >= 30),
cuts AS (
  SELECT lang, k, g, a, c, list_aggregate(w[1:c], 'string_agg', ' ') AS first, list_aggregate(w[c + 1:k], 'string_agg', ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM phrases WHERE k > 1)),
scores AS (
  SELECT s.lang, s.g, s.a, c, x.a AS l, y.a AS r, ((2000000::HUGEINT * s.a) // (x.a + y.a))::BIGINT AS score
  FROM cuts s JOIN phrases x ON x.lang = s.lang AND x.g = first JOIN phrases y ON y.lang = s.lang AND y.g = rest),
lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, c) AS o FROM scores) WHERE o = 1),
around AS (
  SELECT lang, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS g, max(a) AS f
  FROM (SELECT lang, w, k, a, m, unnest(range(1, k - m + 2)) AS i FROM phrases, (VALUES (2), (3)) AS ms(m) WHERE m < k)
  GROUP BY 1, 2),
kept AS (
  SELECT t.lang, t.g, t.a, l, r, score FROM lowest t LEFT JOIN around o ON o.lang = t.lang AND o.g = t.g
  WHERE f IS NULL OR 100 * f < 80 * t.a),
ordered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ordered JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op12_phrases", OP12_SQL)
def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of each language."""
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


def _vector_sql() -> str:
    """Rounds of assignment and update, each as two common table expressions."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} AS (
  SELECT s.rid, s.p, min(struct_pack(d := list_sum(list_transform(list_zip(s.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := c.e)) AS m
  FROM parts s JOIN c{i} c ON c.p = s.p GROUP BY s.rid, s.p)""")
        if i < ROUNDS:
            steps.append(f"""
u{i} AS (
  SELECT p, e, list((t - ((t % n) + n) % n) // n ORDER BY pos) AS v
  FROM (SELECT p, e, pos, sum(x)::BIGINT AS t, count(*) AS n
        FROM (SELECT s.p, a.m.e AS e, unnest(s.v) AS x, generate_subscripts(s.v, 1) AS pos FROM parts s JOIN a{i} a ON a.rid = s.rid AND a.p = s.p)
        GROUP BY p, e, pos)
  GROUP BY p, e),
c{i + 1} AS (SELECT c.p, c.e, coalesce(u.v, c.v) AS v FROM c{i} c LEFT JOIN u{i} u ON u.p = c.p AND u.e = c.e)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT rid, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS v FROM kept, range({PARTS}) AS ps(p)),
c0 AS (SELECT p, rid - 1 AS e, v FROM parts WHERE rid <= {ENTRIES}),
{",".join(steps).strip()},
books AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, pos)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM c{ROUNDS})),
coded AS (
  SELECT rid, string_agg(format('{{:02x}}', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


@query("op13_vector_codes", _vector_sql())
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and squared error of every vector, and the error of its label."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.learned_codebooks(vectors)
    coded = staged(vector_codes.coded(vectors, books).select("row.vec_id", "row.label", "code", "error"), "codes")
    of_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digest = F.sha2(F.lit(books.text() if books else ""), 256)
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256")
    )
