"""Landing, silver and keyed store: what was written is read back and compared."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.operators.dedupe import cap_per_group, first_arrival, lookback, new_rows
from hazlake.operators.normalize import media_records, normalize, raw_records, weather_records
from hazlake.plans.checks import base as b
from hazlake.plans.checks.text_checks import _weather_lines
from hazlake.plans.lake import Lake
from hazlake.session import shared_dir
from hazlake.sources import bronze, tables
from hazlake.sources.payloads import as_parsed


def _land_events(spark: SparkSession, folder: str) -> str:
    """events appended to a bronze folder, one source per event type, one day per date."""
    events = b.load(spark, folder, "events")
    raw_dir = f"{shared_dir(spark)}/raw"
    records = events.select(
        F.col("event_type").alias("source"), F.lit("text").alias("source_type"),
        F.col("event_id").cast("string").alias("record_id"), b.iso_micros(F.col("ts")).alias("collected_at"),
        F.col("props").alias("raw_payload"), F.lit(None).cast("string").alias("text"),
    )
    bronze.append_bronze(records, raw_dir, F.substring("collected_at", 1, 10))
    return raw_dir


@b.check("""
SELECT event_type AS source, strftime(ts, '%Y-%m-%d') AS file_date, count(*)::BIGINT AS records
FROM events GROUP BY ROLLUP (source, file_date)""")
def bronze_line_stats(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.line_stats(bronze.read_lines(spark, _land_events(spark, folder)))


@b.check("""
SELECT CAST(event_id AS VARCHAR) AS record_id, json_extract_string(props, '$.k') AS k, strftime(ts, '%Y-%m-%d') AS file_date
FROM events WHERE event_type = 'click'""")
def bronze_load(spark: SparkSession, folder: str) -> DataFrame:
    """One source of the landing folder, read back line by line."""
    parsed = bronze.load_bronze(spark, _land_events(spark, folder), source="click")
    return parsed.select(
        "rec.record_id", F.get_json_object("rec.raw_payload", "$.k").alias("k"), "file_date"
    )


@b.check("SELECT CAST(event_id AS VARCHAR) AS record_id FROM events WHERE event_type = 'view' AND strftime(ts, '%Y-%m-%d') = '2024-01-09'")
def bronze_source_day(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.load_source_day(spark, _land_events(spark, folder), "view", "2024-01-09").select("record_id")


@b.check("""
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    events = b.load(spark, folder, "events")
    return first_arrival(events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select(
        "event_id", "user_id", "event_type"
    )


@b.check("""
WITH e AS (SELECT *, event_id % 3 = 0 AS late, strftime(ts, '%Y-%m-%d') AS day FROM events),
first AS (SELECT *, row_number() OVER (PARTITION BY late, user_id, event_type, day ORDER BY ts, event_id) AS n FROM e)
SELECT event_id, user_id, event_type, day FROM first f WHERE n = 1 AND late
AND NOT EXISTS (SELECT 1 FROM e WHERE NOT e.late AND e.user_id = f.user_id AND e.event_type = f.event_type AND e.day = f.day)""")
def new_versus_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Every third event whose user had no other of its type on that day."""
    keys, order = ["user_id", "event_type", "day"], [F.col("ts"), F.col("event_id")]
    events = b.load(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    batch = first_arrival(events.filter("event_id % 3 = 0"), keys, order)
    return new_rows(batch, events.filter("event_id % 3 <> 0"), keys).select("event_id", *keys)


_BOTH = b.sql_lake() + """, batches AS (
  SELECT *, 1 AS batch FROM lake
  UNION ALL SELECT * REPLACE (CAST(doc_id + 100 AS VARCHAR) AS record_id,
    sha256(concat(source_type, chr(31), CAST(doc_id + 100 AS VARCHAR))) AS lake_id, concat('2', url) AS url), 2 FROM lake
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source_type, record_id ORDER BY batch, date_partition, collected_at) AS n FROM batches
)"""


@b.check(_BOTH + " SELECT lake_id, source_type, record_id, url, date_partition FROM ranked WHERE n = 1")
def insert_or_ignore(spark: SparkSession, folder: str) -> DataFrame:
    """A batch, an overlapping second batch, and the first again: every key keeps its first arrival."""
    store = shared_dir(spark)
    records = b.doc_records(spark, folder)
    shifted = records.withColumns(
        {"record_id": (F.col("doc_id") + 100).cast("string"), "url": F.concat(F.lit("2"), "url")}
    )
    first = _silver(records)
    for batch in (first, _silver(shifted), first):
        tables.insert_or_ignore(batch, store, "lake_records")
    return tables.read_table(spark, store, "lake_records").select(
        "lake_id", "source_type", "record_id", "url", "date_partition"
    )


def _silver(records: DataFrame) -> DataFrame:
    return normalize(as_parsed(records, "text"), b.TERMS_WHOLE)


@b.check(b.sql_lake() + """
SELECT date_partition AS date, source_type AS source, lake_id, record_id, collected_at, published_at, url, text, language,
  array_to_string(keywords_hit, '|') AS keywords_hit, hazard_type, hazard_severity, location_name, lat, lon, engagement_score FROM lake""")
def silver_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Silver written in full, then one source merged again: same rows, read back by folder."""
    path = f"{shared_dir(spark)}/silver"
    records = b.doc_lake(spark, folder)
    tables.write_silver(records, path)
    tables.write_silver(records.filter("source_type = 'reddit'"), path, merge=True)
    return tables.read_silver(spark, path).select(
        "date", "source", "lake_id", "record_id", "collected_at", "published_at", "url", "text", "language",
        F.array_join("keywords_hit", "|").alias("keywords_hit"), "hazard_type", "hazard_severity", "location_name", "lat", "lon", "engagement_score",
    )


@b.check(b.sql_lake() + " SELECT DISTINCT date_partition AS date, source_type AS source FROM lake")
def silver_partitions(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/silver"
    tables.write_silver(b.doc_lake(spark, folder), path)
    return tables.list_partitions(spark, path)


@b.check(f"""
SELECT DISTINCT 'weather' AS kind, concat('loc_', user_id % 10, '|', {b.SQL_ISO_MICROS}) AS key, concat_ws('|', '90.0', '10.5', '76.25', '1010.0') AS held FROM events
UNION ALL SELECT 'raw', concat(CASE doc_id % 4 WHEN 0 THEN 'twitter' WHEN 1 THEN 'reddit' WHEN 2 THEN 'news_api' ELSE source END, '|', doc_id),
  concat_ws('|', concat('https://example.org/', doc_id), text, array_to_string({b.SQL_HITS}, ',')) FROM documents
UNION ALL SELECT DISTINCT 'media', url, 'images/x|image|12.5|640|480' FROM pages""")
def bronze_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The three typed bronze tables, each filled twice."""
    store = shared_dir(spark)
    weather = weather_records(bronze.parse_lines(_weather_lines(spark, folder)))
    raw = raw_records(as_parsed(b.doc_records(spark, folder), "text"))
    pages = b.load(spark, folder, "pages").select(
        F.col("url").alias("source_url"), F.lit("images/x").alias("local_path"), F.lit("image").alias("media_type"),
        F.lit("2024-02-01T00:00:00+00:00").alias("collected_at"), F.lit(12.5).alias("file_size_kb"), F.lit(640).alias("width"), F.lit(480).alias("height"),
    )
    media = media_records(as_parsed(pages, "media"))
    for name, rows in 2 * [("weather_records", weather), ("raw_records", raw), ("media_records", media)]:
        tables.insert_or_ignore(rows, store, name)
    keys = [
        ("weather", "weather_records", F.concat_ws("|", "location_name", "collected_at"), ["wind_dir_deg", "lat", "lon", "pressure_hpa"]),
        ("raw", "raw_records", F.concat_ws("|", "source_type", "record_id"), ["url", "text", F.array_join("keywords_hit", ",")]),
        ("media", "media_records", F.col("source_url"), ["local_path", "media_type", "file_size_kb", "width", "height"]),
    ]
    parts = [
        tables.read_table(spark, store, name).select(F.lit(kind).alias("kind"), key.alias("key"), F.concat_ws("|", *held).alias("held"))
        for kind, name, key, held in keys
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@b.check("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY")
def lookback_days(spark: SparkSession, folder: str) -> DataFrame:
    return lookback(b.load(spark, folder, "events"), "ts", "2024-01-30 00:00:00", 7).select("event_id")


@b.check("""
SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS n FROM events)
WHERE n <= 100""")
def cap_per_source(spark: SparkSession, folder: str) -> DataFrame:
    events = b.load(spark, folder, "events")
    return cap_per_group(events, "event_type", 100, [F.desc("ts"), F.col("event_id")]).select("event_id", "event_type")


def _lake_of_documents(spark: SparkSession, folder: str) -> Lake:
    """documents landed as bronze lines and ingested into a fresh lake."""
    home = shared_dir(spark)
    records = b.doc_records(spark, folder).drop("doc_id").withColumn("source", F.lower("source_type"))
    bronze.append_bronze(records, f"{home}/raw", F.substring("collected_at", 1, 10))
    lake = Lake(spark, f"{home}/raw", f"{home}/lake", b.TERMS_WHOLE)
    lake.run()
    return lake


@b.check(b.sql_lake() + """
SELECT date_partition, source_type, hazard_type, count(*)::BIGINT AS records, min(lake_id) AS first_id, sum(engagement_score)::DOUBLE AS engagement
FROM lake GROUP BY ALL""")
def ingest_job(spark: SparkSession, folder: str) -> DataFrame:
    """Land, ingest twice, and query the keyed table with a SQL parameter."""
    lake = _lake_of_documents(spark, folder)
    lake.run()
    return lake.db_query(
        "SELECT date_partition, source_type, hazard_type, count(*) AS records, min(lake_id) AS first_id, "
        "sum(engagement_score) AS engagement FROM lake_records WHERE source_type <> :skip GROUP BY ALL", skip="weather",
    )


_LOST_DAY = "2024-01-05"


@b.check(b.sql_lake() + f"""
SELECT 'kept' AS part, lake_id, date_partition AS date, source_type AS source FROM lake WHERE date_partition <> '{_LOST_DAY}'
UNION ALL SELECT DISTINCT 'unread', NULL, date_partition, source_type FROM lake WHERE date_partition = '{_LOST_DAY}'""")
def silver_unread_files(spark: SparkSession, folder: str) -> DataFrame:
    """Silver of which one day's files were cut off after their first bytes: the rest is loaded, those are named."""
    path = f"{shared_dir(spark)}/silver"
    tables.write_silver(b.doc_lake(spark, folder), path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/date={_LOST_DAY}/*/*.parquet")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for file in fs.globStatus(pattern):
        out = fs.create(file.getPath(), True)
        out.writeBytes("PAR1")
        out.close()
    kept = tables.reload_silver(spark, path)
    unread = tables.unread_files(spark, path).filter("promised IS NULL AND found = 0")
    at = r"date=([^/]+)/source=([^/]+)/"
    named = unread.select(F.regexp_extract("file", at, 1).alias("date"), F.regexp_extract("file", at, 2).alias("source")).distinct()
    return kept.select(F.lit("kept").alias("part"), "lake_id", F.col("date_partition").alias("date"), F.col("source_type").alias("source")).unionByName(
        named.select(F.lit("unread").alias("part"), F.lit(None).cast("string").alias("lake_id"), "date", "source")
    )
