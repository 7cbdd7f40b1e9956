"""One registered query per operator, each over its whole table with the operator's own defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.llm import audit_checks, decontaminate, neardup, ngram, packing, quality, repair, revisits, sitetree, snapshots, tokencount
from hazlake.llm.registry import QUERIES, SQL, query, table
from hazlake.llm.tokens import tokenizer_path
from hazlake.session import shared_dir

__all__ = ["QUERIES", "SQL", "audit_checks"]

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))

_LANGUAGES = ", ".join(f"'{x}'" for x in quality.STOP_WORDS_OF)

OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), repeats AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1
), gaps AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM repeats
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(next - i, 8)))::BIGINT AS n FROM gaps GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains([{_STOPS}], lower(x)))) AS n_stop,
    len(list_filter(w, lambda x: regexp_matches(x, '[^\\P{{L}}\\p{{Latin}}]'))) * 2 < len(w)
      AND coalesce(regexp_extract(lower(lang), '^\\s*([a-z]*)', 1), '') IN ('', 'und', {_LANGUAGES}) AS listed,
    len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_letter,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters,
    len(list_filter(lines, lambda l: regexp_matches(l, '^\\s*[-*•‣●]\\s'))) AS n_bullet,
    len(list_filter(lines, lambda l: regexp_matches(l, '(\\.\\.\\.|…)\\s*$'))) AS n_ellipsis
  FROM d LEFT JOIN covered c USING (doc_id)
), base AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.3 AND (n_stop / n_words >= 0.02 OR NOT listed)
    AND n_letter / n_words >= 0.6 AND n_stutters / n_words <= 0.3 AND n_dup_lines / n_lines <= 0.5 AND n_bullet / n_lines <= 0.9
    AND n_ellipsis / n_lines <= 0.3 AS kept
FROM base
"""


@query(OP4_SQL)
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return quality.judged(docs, language="lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


@query()
def op10_min_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document."""
    return packing.pack(table(spark, folder, "documents"), tokenizer_path(WORD_BPE))


@query()
def op7_transducer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is longer than the limit."""
    counts = tokencount.token_counts(table(spark, folder, "documents"), tokenizer_path(BYTE_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > tokencount.LIMIT)


@query()
def op6_repair_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Write every document's ids, then read each one's start, length and checksum back from the files."""
    files = f"{shared_dir(spark)}/ids"
    repair.write_ids(table(spark, folder, "documents"), files, tokenizer_path(BYTE_BPE))
    return repair.read_documents(spark, files)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_shingles(source: str, key: str, size: int) -> str:
    """SELECT of the distinct (key, shingle) of a table's texts."""
    words = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+')"
    return f"""
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {size}
      THEN list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' '))
      ELSE [array_to_string(w, ' ')] END) AS shingle
  FROM (SELECT {key}, {words} AS w FROM {source}) WHERE len(w) > 0"""


OP5_SQL = f"""
WITH d AS ({_sql_shingles('documents', 'doc_id', decontaminate.SHINGLE)}),
b AS ({_sql_shingles('benchmark', 'item_id', decontaminate.SHINGLE)}),
sizes AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM d JOIN b USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""


@query(OP5_SQL)
def op5_containment_search(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item it contains."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP2_SHINGLE = 4


@query()
def op2_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under links of four-word shingle sets."""
    return neardup.near_duplicates(table(spark, folder, "documents"), OP2_SHINGLE)


@query()
def op8_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return sitetree.extract(table(spark, folder, "pages"))


@query()
def op3_elias_fano_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document under the model of those that are not held out."""
    return ngram.train_and_score(table(spark, folder, "documents"))


OP1_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), c AS (
  SELECT conv_id, count(*)::INT AS n_turns, max(turn) AS last,
    string_agg(concat(turn, chr(1), role, chr(1), text, chr(2)), '' ORDER BY turn, role, text) AS sign,
    string_agg(concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)), '' ORDER BY turn, role, text) AS text
  FROM t GROUP BY conv_id
), p AS (
  SELECT DISTINCT md5(string_agg(concat(turn, chr(1), role, chr(1), text, chr(2)), '')
    OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)) AS prefix,
    lead(turn) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS next, turn
  FROM t
), u AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies, any_value(n_turns) AS n_turns, sign, any_value(text) AS text FROM c GROUP BY sign
)
SELECT conv_id, copies, n_turns, text FROM u WHERE md5(sign) NOT IN (SELECT prefix FROM p WHERE next > turn)
"""


@query(OP1_SQL)
def op1_snapshot_collapse(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation that no longer one continues, rendered."""
    return snapshots.rendered(table(spark, folder, "conversations"))


def page_captures(spark: SparkSession, folder: str) -> DataFrame:
    """The pages as captures: two in three are responses, the others not-modified answers, at ten addresses of their host."""
    page = F.col("page_id")
    host = F.regexp_extract("url", "://([^/:?#]+)", 1)
    spelt = F.when(page % 4 == 0, F.concat(F.lit("HTTP://www."), F.upper(host), F.lit(":80"))).otherwise(F.concat(F.lit("https://"), host))
    url = F.concat(spelt, F.lit("/item/"), (page % 10).cast("string"), F.when(page % 5 == 0, "?utm_source=x&b=1&a=2#top").otherwise("/?a=2&b=1"))
    stale = page % 3 == 0
    at = F.timestamp_seconds(1_700_000_000 + page * 7_919 % 5_000_000)
    tag = F.when(page % 7 != 0, F.concat(F.when(page % 11 == 0, "W/").otherwise(""), F.lit('"v'), (page % 10 % 3 + F.when(page % 40 == 1, 1).otherwise(0)).cast("string"), F.lit('"')))
    size = F.octet_length("html").cast("string")
    names = F.array(*[F.lit(n) for n in ("ETag", "Date", "Cache-Control", "Content-Length", "Content-Type", "CONNECTION")])
    values = F.array(
        tag, page.cast("string"), F.concat(F.lit("max-age="), (page % 100).cast("string")), F.when(stale, "0").otherwise(size),
        F.when(~stale, "text/html"), F.when(stale, "close"),
    )
    headers = F.map_filter(F.map_from_arrays(names, values), lambda k, v: v.isNotNull())
    payload = F.when(~stale, F.md5("html"))
    return table(spark, folder, "pages").select(
        page.alias("record_id"), url.alias("url"), at.alias("at"), F.when(stale, 304).otherwise(200).alias("status"), headers.alias("headers"), payload.alias("payload"),
    )


OP9_SQL = """
WITH c AS (
  SELECT page_id AS record_id, concat(regexp_replace(lower(concat(CASE WHEN page_id % 4 = 0 THEN 'www.' ELSE '' END, regexp_extract(url, '://([^/:?#]+)', 1))), '^www\\.', ''), '/item/', page_id % 10, '/?a=2&b=1') AS place,
    page_id * 7919 % 5000000 AS at, page_id % 3 = 0 AS stale, strlen(html) AS size, md5(html) AS digest,
    CASE WHEN page_id % 7 <> 0 THEN concat(CASE WHEN page_id % 11 = 0 THEN 'W/' ELSE '' END, '"v', page_id % 10 % 3 + CASE WHEN page_id % 40 = 1 THEN 1 ELSE 0 END, '"') END AS tag
  FROM pages
), f AS (
  SELECT r.*, s.record_id AS source_id, s.size AS stored_size, s.digest AS stored_digest, s.tag AS stored_tag,
    row_number() OVER (PARTITION BY r.record_id ORDER BY s.at DESC, s.record_id DESC) AS k
  FROM c r LEFT JOIN c s ON s.place = r.place AND NOT s.stale AND s.at < r.at WHERE r.stale
), o AS (
  SELECT *, CASE WHEN source_id IS NULL THEN 'no_earlier'
    WHEN tag IS NOT NULL AND stored_tag IS NOT NULL AND (tag = stored_tag OR ((tag LIKE 'W/%' OR stored_tag LIKE 'W/%') AND replace(tag, 'W/', '') = replace(stored_tag, 'W/', ''))) THEN 'resolved'
    WHEN tag IS NOT NULL THEN 'changed' WHEN stored_tag IS NULL THEN 'resolved' ELSE 'unconfirmed' END AS outcome
  FROM f WHERE k = 1
)
SELECT record_id, place, source_id, outcome, CASE WHEN outcome = 'resolved' THEN stored_digest END AS payload,
  CASE WHEN outcome = 'resolved'
    THEN concat('cache-control=max-age=', record_id % 100, ';content-length=', stored_size, ';content-type=text/html;date=', record_id, CASE WHEN tag IS NULL THEN '' ELSE concat(';etag=', tag) END)
    ELSE concat('cache-control=max-age=', record_id % 100, ';connection=close;content-length=0;date=', record_id, CASE WHEN tag IS NULL THEN '' ELSE concat(';etag=', tag) END) END AS headers
FROM o
"""


@query(OP9_SQL)
def op9_not_modified(spark: SparkSession, folder: str) -> DataFrame:
    """Every not-modified capture with the response it stands for, its payload's digest and its headers in order."""
    found = revisits.resolve(page_captures(spark, folder))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("record_id", "place", "source_id", "outcome", "payload", F.array_join(lines, ";").alias("headers"))
