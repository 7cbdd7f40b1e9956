"""The registry, and how the given tables are read as hazard records.

The tables hold invented words, so labels use fragments that occur in them
instead of the real term lists. Every derived column is written once here as a
Spark expression and once as SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazlake.functions.classify import keyword_hits
from hazlake.operators.normalize import normalize
from hazlake.session import apply_conf
from hazlake.sources.payloads import as_parsed
from hazlake.taxonomy import Taxonomy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with SQL if given."""
    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query

    return register


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return apply_conf(spark).read.parquet(f"{folder}/{table}.parquet")


# Rows of a landed file at most: one task reads it whole, because it is compressed.
LANDED_ROWS = 50_000


def land(lines: DataFrame, path: str, parts: int = 1) -> int:
    """Write the lines of a column as compressed text, ``parts`` files or more; returns how many there are.

    Tasks write what they read, so the files grow in number with the input and nothing is shuffled.
    """
    rows = LANDED_ROWS if parts == 1 else max(1, min(LANDED_ROWS, -(-lines.count() // parts)))
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    lines.write.options(**packed).option("maxRecordsPerFile", rows).text(path)
    spark = lines.sparkSession
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    return len(pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern))


# Rounding for comparison. The nudge decides exact ties the same way on both sides.
def r6(col: Column) -> Column:
    return F.round(col + 1e-9, 6)


def sql_r6(expr: str) -> str:
    return f"round({expr} + 1e-9, 6)"


KEYWORDS = ["of the", "The Of", "and The", "de la", "la de", "der und", "is on", "that with", "the ing", "sch"]
HAZARDS = (("A", ("thing",)), ("B", ("ment",)), ("C", ("eau",)))
TERMS_500 = Taxonomy(hazards=HAZARDS, critical=("sos",), warning=("ther",), scan_chars=500)
TERMS_WHOLE = Taxonomy(hazards=HAZARDS, critical=("sos",), warning=("ther",), scan_chars=None)

SQL_HITS = "list_filter([" + ", ".join(f"'{k}'" for k in KEYWORDS) + "], lambda k: contains(lower(text), lower(k)))"


def sql_corpus(hits: str, text: str, chars: int | None = 500) -> str:
    body = text if chars is None else f"substring({text}, 1, {chars})"
    return f"lower(concat(array_to_string({hits}, ' '), CASE WHEN length({text}) > 0 THEN concat(' ', {body}) ELSE '' END))"


def sql_hazard(corpus: str) -> str:
    arms = " ".join(f"WHEN contains({corpus}, '{terms[0]}') THEN '{name}'" for name, terms in HAZARDS)
    return f"CASE {arms} END"


def sql_severity(corpus: str) -> str:
    return f"CASE WHEN contains({corpus}, 'sos') THEN 'CRITICAL' WHEN contains({corpus}, 'ther') THEN 'WARNING' ELSE 'INFO' END"


# -- documents as text records ------------------------------------------------


def _id() -> Column:
    return F.col("doc_id")


def iso_seconds(day: Column, second: Column) -> Column:
    """ISO text of 2024-01-01 plus days plus seconds."""
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + day * 86_400 + second)
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def doc_records(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    text_none = F.lit(None).cast("string")
    source = (
        F.when(_id() % 4 == 0, "Twitter").when(_id() % 4 == 1, "reddit").when(_id() % 4 == 2, "news_api")
        .otherwise(F.col("source"))
    )
    collected = iso_seconds(_id() % 30, _id() * 7919 % 86_400)
    location = F.when(
        _id() % 7 != 0,
        F.struct(
            F.concat(F.lit("loc_"), (_id() % 10).cast("string")).alias("name"),
            (8 + (_id() * 37 % 2900) / 100.0).alias("lat"),
            (68 + (_id() * 53 % 2900) / 100.0).alias("lon"),
        ),
    )
    metrics = F.when(
        _id() % 12 != 0,
        F.struct(
            (_id() % 5).alias("retweet_count"), (F.col("n_chars") % 100).alias("like_count"),
            (_id() % 3).alias("reply_count"), F.when(_id() % 8 != 0, _id() % 2).alias("quote_count"),
        ),
    )
    payload = F.to_json(
        F.struct(
            metrics.alias("public_metrics"), (F.col("n_chars") % 50 - 5).alias("score"),
            F.when(_id() % 5 != 0, _id() % 9).alias("num_comments"),
        )
    )
    url = F.concat(F.lit("https://example.org/"), _id().cast("string"))
    return docs.select(
        "doc_id",
        source.alias("source_type"),
        F.concat(F.lit("feed_"), "source").alias("source_name"),
        _id().cast("string").alias("record_id"),
        collected.alias("collected_at"),
        F.when(_id() % 5 != 0, collected).otherwise(text_none).alias("published_at"),
        url.alias("url"),
        "text",
        F.when(_id() % 11 != 0, F.col("lang")).alias("language"),
        keyword_hits(F.col("text"), KEYWORDS).alias("keywords_hit"),
        location.alias("location"),
        F.when(_id() % 3 == 0, F.array(F.concat(url, F.lit(".jpg")))).alias("media_urls"),
        payload.alias("raw_payload"),
    )


def doc_lake(spark: SparkSession, folder: str, taxonomy: Taxonomy = TERMS_WHOLE) -> DataFrame:
    """documents as silver records; labels search the whole text."""
    return normalize(as_parsed(doc_records(spark, folder), "text"), taxonomy)


def sql_lake(chars: int | None = None) -> str:
    """CTE ``lake``: the silver record of every document, with ``doc_id``."""
    return f"""
WITH lines AS (
  SELECT doc_id, text, lang, source, n_chars, {SQL_HITS} AS hits,
    CASE doc_id % 4 WHEN 0 THEN 'twitter' WHEN 1 THEN 'reddit' WHEN 2 THEN 'news_api' ELSE source END AS source_type,
    strftime(TIMESTAMP '2024-01-01' + (doc_id % 30) * INTERVAL 1 DAY + (doc_id * 7919 % 86400) * INTERVAL 1 SECOND,
             '%Y-%m-%dT%H:%M:%S+00:00') AS collected_at
  FROM documents
), scanned AS (
  SELECT *, {sql_corpus('hits', 'text', chars)} AS corpus FROM lines
), labelled AS (
  SELECT *, {sql_hazard('corpus')} AS hazard_type FROM scanned
), lake AS (
  SELECT doc_id, sha256(concat(source_type, chr(31), CAST(doc_id AS VARCHAR))) AS lake_id, source_type,
    concat('feed_', source) AS source_name, CAST(doc_id AS VARCHAR) AS record_id, collected_at,
    CASE WHEN doc_id % 5 <> 0 THEN collected_at END AS published_at,
    substring(collected_at, 1, 10) AS date_partition, concat('https://example.org/', doc_id) AS url, text,
    CASE WHEN doc_id % 11 <> 0 THEN lang ELSE 'en' END AS language, hits AS keywords_hit, hazard_type,
    CASE WHEN hazard_type IS NOT NULL THEN {sql_severity('corpus')} END AS hazard_severity,
    CASE WHEN doc_id % 7 <> 0 THEN concat('loc_', doc_id % 10) END AS location_name,
    CASE WHEN doc_id % 7 <> 0 THEN 8 + (doc_id * 37 % 2900) / 100.0 END::DOUBLE AS lat,
    CASE WHEN doc_id % 7 <> 0 THEN 68 + (doc_id * 53 % 2900) / 100.0 END::DOUBLE AS lon,
    CASE WHEN doc_id % 3 = 0 THEN concat('https://example.org/', doc_id, '.jpg') ELSE '' END AS media_urls,
    CASE WHEN source_type = 'twitter' AND doc_id % 12 <> 0
           THEN (doc_id % 5) * 2 + n_chars % 100 + doc_id % 3 + CASE WHEN doc_id % 8 <> 0 THEN doc_id % 2 ELSE 0 END
         WHEN source_type = 'reddit'
           THEN n_chars % 50 - 5 + CASE WHEN doc_id % 5 <> 0 THEN doc_id % 9 ELSE 0 END * 1.5
    END::DOUBLE AS engagement_score
  FROM labelled
)"""


# -- events as weather readings and hazard events --------------------------------


def iso_micros(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


SQL_ISO_MICROS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def event_readings(spark: SparkSession, folder: str) -> DataFrame:
    """events other than errors as weather readings of ten places."""
    value, kind = F.col("value"), F.col("event_type")
    at = iso_micros(F.col("ts"))
    return load(spark, folder, "events").filter(kind != "error").select(
        "event_id",
        F.concat(F.lit("loc_"), (F.col("user_id") % 10).cast("string")).alias("location_name"),
        (8 + F.col("user_id") % 10).cast("double").alias("lat"),
        (70 + F.col("user_id") % 10).cast("double").alias("lon"),
        at.alias("collected_at"),
        F.substring(at, 1, 10).alias("date_partition"),
        F.when(kind != "signup", value / 10).alias("temperature_c"),
        F.when(kind != "view", value % 100).alias("humidity_pct"),
        F.when(kind != "purchase", value / 7).alias("wind_speed_ms"),
        (value % 360).alias("wind_dir_deg"),
        F.when(kind.isin("purchase", "signup"), 0.0).otherwise(value).alias("rainfall_mm"),
        F.when(kind != "click", 990 + value % 30).alias("pressure_hpa"),
        kind.alias("condition"),
    )


SQL_READINGS = f"""
readings AS (
  SELECT event_id, concat('loc_', user_id % 10) AS location_name, (8 + user_id % 10)::DOUBLE AS lat,
    (70 + user_id % 10)::DOUBLE AS lon, ts, epoch_us(ts) AS us, {SQL_ISO_MICROS} AS collected_at,
    strftime(ts, '%Y-%m-%d') AS date_partition,
    CASE WHEN event_type <> 'signup' THEN value / 10 END AS temperature_c,
    CASE WHEN event_type <> 'view' THEN value % 100 END AS humidity_pct,
    CASE WHEN event_type <> 'purchase' THEN value / 7 END AS wind_speed_ms,
    value % 360 AS wind_dir_deg,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 0.0 ELSE value END AS rainfall_mm,
    CASE WHEN event_type <> 'click' THEN 990 + value % 30 END AS pressure_hpa
  FROM events WHERE event_type <> 'error'
)"""


def event_hazards(spark: SparkSession, folder: str) -> DataFrame:
    """error events as hazard events of the same places."""
    return load(spark, folder, "events").filter("event_type = 'error'").select(
        F.concat(F.lit("loc_"), (F.col("user_id") % 10).cast("string")).alias("location_name"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("H"), (F.col("event_id") % 9).cast("string")).alias("hazard_type"),
    )


SQL_HAZARDS = """
hazards AS (
  SELECT concat('loc_', user_id % 10) AS location_name, epoch_us(ts) AS us, concat('H', event_id % 9) AS hazard_type
  FROM events WHERE event_type = 'error'
)"""
