"""Registered queries of the operators on licences, hard negatives and source divergence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.llm import divergence, hardneg, licences
from hazlake.llm.registry import query, table


@query()
def op13_licence_automaton(spark: SparkSession, folder: str) -> DataFrame:
    """Places of licence phrases and labels of licence texts in every document."""
    return licences.scan(table(spark, folder, "documents")).drop("spans")


OP12_SQL = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({hardneg.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS id, a.label = o.label AS same, list_sum(list_transform(list_zip(a.v, o.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e a JOIN e o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {hardneg.POSITIVES}
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {hardneg.LEAST_PERCENT} * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= {hardneg.NEGATIVES}
"""


@query(OP12_SQL)
def op12_one_bit_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The best five negatives under each of the best five positives of every hundredth vector."""
    vec = F.col("vec_id")
    label = F.when(vec % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").select(vec.alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hardneg.mine(vectors, F.col("id") % 100 == 0)


OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
g AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= {divergence.LEAST_DOCS}),
kl AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT s.lang, s.source, k.term, coalesce(g.n, 0) AS n, 1 + {divergence.GRAIN}::HUGEINT * (k.n + 1) // (kl.total + kl.v) AS q,
    sum(coalesce(g.n, 0)) OVER (PARTITION BY s.lang, s.source) AS total, kl.v
  FROM s JOIN k ON k.lang = s.lang JOIN kl ON kl.lang = s.lang LEFT JOIN g ON g.lang = s.lang AND g.source = s.source AND g.term = k.term
), p AS (SELECT *, 1 + {divergence.GRAIN}::HUGEINT * (n + 1) // (total::HUGEINT + v) AS p FROM c),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
), terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank
FROM terms QUALIFY rank <= {divergence.TOP}
"""


@query(OP11_SQL)
def op11_late_terms(spark: SparkSession, folder: str) -> DataFrame:
    """How far every source's words lie from those of its language's other sources, and its own words."""
    return divergence.audit(table(spark, folder, "documents"))
