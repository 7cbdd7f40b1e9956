"""Labels, keywords, cleaning and normalising."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.functions.classify import hazard_severity, hazard_type, keyword_hits
from hazlake.functions.payload import engagement_score
from hazlake.functions.text import clean_text, label_confidence
from hazlake.operators.normalize import bronze_shape, ingest_counts, normalize
from hazlake.plans.checks import base as b
from hazlake.sources.bronze import malformed, parse_lines

_HITS = f"WITH d AS (SELECT doc_id, text, {b.SQL_HITS} AS hits FROM documents), " \
        f"c AS (SELECT *, {b.sql_corpus('hits', 'text')} AS lead, {b.sql_corpus('hits', 'text', None)} AS whole FROM d) "


@b.check(_HITS + f"SELECT doc_id, {b.sql_hazard('lead')} AS hazard_type, {b.sql_hazard('whole')} AS hazard_type_whole FROM c")
def hazard_classify(spark: SparkSession, folder: str) -> DataFrame:
    """By the lake's rule (leading 500 characters) and over the whole text."""
    docs = b.load(spark, folder, "documents").withColumn("hits", keyword_hits(F.col("text"), b.KEYWORDS))
    return docs.select(
        "doc_id",
        hazard_type(F.col("hits"), F.col("text"), b.TERMS_500).alias("hazard_type"),
        hazard_type(F.col("hits"), F.col("text"), b.TERMS_WHOLE).alias("hazard_type_whole"),
    )


@b.check(_HITS + f"SELECT doc_id, {b.sql_severity('lead')} AS severity, {b.sql_severity('whole')} AS severity_whole, "
         "CASE WHEN doc_id % 3 = 0 THEN 'CRITICAL' WHEN doc_id % 3 = 1 THEN 'WARNING' "
         f"ELSE {b.sql_severity('whole')} END AS severity_marked FROM c")
def severity_classify(spark: SparkSession, folder: str) -> DataFrame:
    docs = b.load(spark, folder, "documents").withColumn("hits", keyword_hits(F.col("text"), b.KEYWORDS))
    mark = (
        F.when(F.col("doc_id") % 3 == 0, "[CRITICAL RAINFALL] WARNING").when(F.col("doc_id") % 3 == 1, "[WARNING RAINFALL]")
    )
    return docs.select(
        "doc_id",
        hazard_severity(F.col("hits"), F.col("text"), b.TERMS_500).alias("severity"),
        hazard_severity(F.col("hits"), F.col("text"), b.TERMS_WHOLE).alias("severity_whole"),
        hazard_severity(F.col("hits"), F.col("text"), b.TERMS_WHOLE, mark).alias("severity_marked"),
    )


@b.check(_HITS + "SELECT doc_id, array_to_string(hits, '|') AS hits, len(hits)::BIGINT AS n_hits FROM d")
def keyword_hit_list(spark: SparkSession, folder: str) -> DataFrame:
    hits = keyword_hits(F.col("text"), b.KEYWORDS)
    return b.load(spark, folder, "documents").select(
        "doc_id", F.array_join(hits, "|").alias("hits"), F.size(hits).cast("bigint").alias("n_hits")
    )


def _flat(lake: DataFrame) -> DataFrame:
    return lake.withColumns({c: F.array_join(c, "|") for c in ("keywords_hit", "media_urls")})


@b.check(b.sql_lake() + """
SELECT lake_id, source_type, source_name, record_id, collected_at, published_at, date_partition, url, text, language,
  array_to_string(keywords_hit, '|') AS keywords_hit, hazard_type, hazard_severity, location_name, lat, lon, media_urls,
  engagement_score
FROM lake""")
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    """documents as landed JSON lines, through the line parser to silver."""
    records = b.doc_records(spark, folder).drop("doc_id").withColumn("raw_payload", F.parse_json("raw_payload"))
    lines = records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))
    return _flat(normalize(parse_lines(lines), b.TERMS_WHOLE)).select(
        "lake_id", "source_type", "source_name", "record_id", "collected_at", "published_at", "date_partition", "url",
        "text", "language", "keywords_hit", "hazard_type", "hazard_severity", "location_name", "lat", "lon",
        "media_urls", "engagement_score",
    )


def _weather_lines(spark: SparkSession, folder: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    condition = (
        F.when(kind == "click", "Heavy Rain").when(kind == "view", "[WARNING RAINFALL] mist")
        .when(kind == "signup", "Snowfall").when(kind == "error", "[CRITICAL RAINFALL] drizzle")
    )
    events = b.load(spark, folder, "events")
    record = F.struct(
        F.concat(F.lit("loc_"), (F.col("user_id") % 10).cast("string")).alias("location_name"),
        F.lit(10.5).alias("lat"), F.lit(76.25).alias("lon"),
        b.iso_micros(F.col("ts")).alias("collected_at"),
        F.when(kind != "view", value / 10).alias("temperature_c"),
        F.round(value).cast("bigint").alias("humidity_pct"),
        (value / 8).alias("wind_speed_ms"), F.lit(90).alias("wind_dir_deg"),
        F.when(kind != "purchase", value / 10).alias("rainfall_mm"),
        F.lit(1010).alias("pressure_hpa"), condition.alias("condition"),
        F.parse_json(F.lit('{"cod": 200}')).alias("raw_payload"),
    )
    return events.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("line"))


@b.check(f"""
WITH w AS (
  SELECT concat('loc_', user_id % 10) AS location_name, {b.SQL_ISO_MICROS} AS collected_at, value, event_type,
    CASE WHEN event_type <> 'purchase' THEN value / 10 END AS rainfall_mm, coalesce(CASE WHEN event_type <> 'purchase' THEN value / 10 END, 0) AS rain,
    CASE event_type WHEN 'click' THEN 'Heavy Rain' WHEN 'view' THEN '[WARNING RAINFALL] mist' WHEN 'signup' THEN 'Snowfall'
      WHEN 'error' THEN '[CRITICAL RAINFALL] drizzle' ELSE '' END AS condition
  FROM events
), k AS (
  SELECT *, CASE WHEN rain >= 35 OR event_type = 'error' THEN 'critical rainfall' WHEN rain >= 15 OR event_type = 'view' THEN 'heavy rainfall' ELSE '' END AS kw FROM w
)
SELECT sha256(concat('weather', chr(31), 'weather_', location_name, '_', collected_at)) AS lake_id, location_name, collected_at,
  substring(collected_at, 1, 10) AS date_partition, kw AS keywords_hit,
  CASE WHEN event_type = 'signup' AND kw <> 'heavy rainfall' THEN 'COLD_WAVE' WHEN event_type = 'signup' THEN 'COLD_WAVE'
       WHEN event_type = 'click' OR kw = 'heavy rainfall' OR rain >= 15 THEN 'CLOUDBURST' END AS hazard_type,
  CASE kw WHEN 'critical rainfall' THEN 'CRITICAL' WHEN 'heavy rainfall' THEN 'WARNING' ELSE 'INFO' END AS hazard_severity,
  CASE WHEN event_type <> 'view' THEN value / 10 END AS temperature_c, round(value)::DOUBLE AS humidity_pct,
  value / 8 AS wind_speed_ms, rainfall_mm, 1010::DOUBLE AS pressure_hpa, condition AS weather_condition, 10.5::DOUBLE AS lat
FROM k""")
def normalize_weather(spark: SparkSession, folder: str) -> DataFrame:
    """events as landed weather lines, with the real term lists."""
    return _flat(normalize(parse_lines(_weather_lines(spark, folder)))).select(
        "lake_id", "location_name", "collected_at", "date_partition", "keywords_hit", "hazard_type", "hazard_severity",
        "temperature_c", "humidity_pct", "wind_speed_ms", "rainfall_mm", "pressure_hpa", "weather_condition", "lat",
    )


@b.check("""
WITH m AS (
  SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN concat('r', page_id) END AS rid, length(html) AS n FROM pages
)
SELECT sha256(concat('media', chr(31), coalesce(rid, url))) AS lake_id, 'media' AS source_type, 'media_collector' AS source_name,
  coalesce(rid, url) AS record_id, '2024-02-01' AS date_partition, url, url AS media_urls,
  CASE WHEN page_id % 2 = 0 THEN 'image' ELSE 'video' END AS media_type, concat('images/', page_id) AS local_path,
  (n / 4)::DOUBLE AS file_size_kb, CAST(NULL AS VARCHAR) AS hazard_type
FROM m""")
def normalize_media(spark: SparkSession, folder: str) -> DataFrame:
    """pages as landed media lines."""
    page = F.col("page_id")
    record = F.struct(
        F.col("url").alias("source_url"), F.concat(F.lit("images/"), page.cast("string")).alias("local_path"),
        F.when(page % 2 == 0, "image").otherwise("video").alias("media_type"),
        F.lit("2024-02-01T00:00:00+00:00").alias("collected_at"),
        F.when(page % 3 == 0, F.concat(F.lit("r"), page.cast("string"))).alias("source_record_id"),
        (F.length("html") / 4).alias("file_size_kb"), F.lit(640).alias("width"), F.lit(480).alias("height"),
    )
    lines = b.load(spark, folder, "pages").select(F.to_json(record, {"ignoreNullFields": "false"}).alias("line"))
    return _flat(normalize(parse_lines(lines))).select(
        "lake_id", "source_type", "source_name", "record_id", "date_partition", "url", "media_urls", "media_type",
        "local_path", "file_size_kb", "hazard_type",
    )


def mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One line per event, of every kind a landing folder may hold."""
    n, props = F.col("event_id"), F.col("props")
    at = b.iso_micros(F.col("ts"))
    opened = F.regexp_replace(props, r"\}$", "")
    line = (
        F.when(n % 8 == 0, F.concat(opened, F.lit(', "temperature_c": null, "location_name": "A", "collected_at": "'), at, F.lit('"}')))
        .when(n % 8 == 1, F.concat(opened, F.lit(', "source_url": "u", "local_path": null, "collected_at": "'), at, F.lit('"}')))
        .when(n % 8 == 2, F.concat(opened, F.lit(', "source_type": "Src", "record_id": "'), n.cast("string"), F.lit('", "collected_at": "'), at, F.lit('"}')))
        .when(n % 8 == 3, props)
        .when(n % 8 == 4, F.concat(props, F.lit(" x")))
        .when(n % 8 == 5, F.regexp_replace(props, '"', "'"))
        .when(n % 8 == 6, F.concat(props, F.lit(","), props))
        .otherwise(F.concat(opened, F.lit(', "source_type": "src"}')))
    )
    return b.load(spark, folder, "events").select("event_id", line.alias("line"))


@b.check("""
SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'weather' WHEN 1 THEN 'media' WHEN 2 THEN 'text' WHEN 7 THEN 'text' END AS shape,
  CASE event_id % 8 WHEN 0 THEN 'weather' WHEN 1 THEN 'media' WHEN 2 THEN 'text' WHEN 3 THEN 'text' WHEN 7 THEN 'text' END AS bronze_shape
FROM events""")
def shape_route(spark: SparkSession, folder: str) -> DataFrame:
    return parse_lines(mixed_lines(spark, folder)).select(
        "event_id", F.nullif("shape", F.lit("unknown")).alias("shape"), bronze_shape().alias("bronze_shape")
    )


@b.check("SELECT event_id FROM events WHERE event_id % 8 IN (4, 5, 6)")
def malformed_skip(spark: SparkSession, folder: str) -> DataFrame:
    return malformed(mixed_lines(spark, folder)).select("event_id")


@b.check("""
SELECT count(*) FILTER (event_id % 8 IN (0, 1, 2, 3, 7))::BIGINT AS loaded, count(*) FILTER (event_id % 8 IN (0, 1, 2))::BIGINT AS normalized,
  count(*) FILTER (event_id % 8 IN (3, 7))::BIGINT AS skipped, count(*) FILTER (event_id % 8 IN (4, 5, 6))::BIGINT AS malformed,
  count(DISTINCT CASE WHEN event_id % 8 IN (0, 1, 2) THEN concat(strftime(ts, '%Y-%m-%d'), event_id % 8) END)::BIGINT AS partitions
FROM events""")
def ingest_counters(spark: SparkSession, folder: str) -> DataFrame:
    return ingest_counts(parse_lines(mixed_lines(spark, folder)))


# RE2 has no Unicode \s: the characters it lacks are listed.
_URL_SQL = r"(?i)(?:https?://|www\.)[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _sql_clean(text: str) -> str:
    out = text
    for pattern in (_URL_SQL, "<[^>]+>", r"[^\x20-\x7E]", r"\s+"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return f"nullif(trim({out}), '')"


_CLEAN_INPUT = """
WITH t AS (
  SELECT concat('p', page_id) AS id, concat('See ', url, chr(160), 'WWW.', page_id, ' ', html) AS text FROM pages
  UNION ALL SELECT concat('d', doc_id), text FROM documents
)"""


def _mixed_texts(spark: SparkSession, folder: str) -> DataFrame:
    pages = b.load(spark, folder, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.concat(F.lit("See "), "url", F.lit(" WWW."), F.col("page_id").cast("string"), F.lit(" "), "html").alias("text"),
    )
    docs = b.load(spark, folder, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    return pages.unionByName(docs)


@b.check(_CLEAN_INPUT + f" SELECT id, {_sql_clean('text')} AS text FROM t")
def text_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed_texts(spark, folder).select("id", clean_text(F.col("text")).alias("text"))


def sql_confidence(text: str, hits: str) -> str:
    words = f"len(list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> ''))"
    hit_words = f"coalesce(list_sum(list_transform({hits}, lambda k: len(string_split(k, ' ')))), 0)"
    # The nudge rounds an exact half up, as the decimal rounding on the Spark side does.
    return (
        f"CASE WHEN coalesce({words}, 0) > 0 AND {hit_words} > 0 "
        f"THEN least(1.0, round({hit_words}::DOUBLE / {words} + 1e-12, 4)) ELSE 0.0 END::DOUBLE"
    )


@b.check(f"""
WITH d AS (SELECT doc_id, {b.SQL_HITS} AS hits, {_sql_clean('text')} AS text FROM documents)
SELECT doc_id, {sql_confidence('text', 'hits')} AS label_confidence FROM d""")
def label_confidence_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = b.load(spark, folder, "documents").withColumn("hits", keyword_hits(F.col("text"), b.KEYWORDS))
    return docs.select("doc_id", label_confidence(clean_text(F.col("text")), F.col("hits")).alias("label_confidence"))


@b.check(b.sql_lake() + " SELECT doc_id, engagement_score FROM lake")
def engagement(spark: SparkSession, folder: str) -> DataFrame:
    return b.doc_records(spark, folder).select(
        "doc_id", engagement_score(F.lower("source_type"), F.col("raw_payload")).alias("engagement_score")
    )
