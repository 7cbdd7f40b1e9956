"""Whole jobs: collection from landed payloads, migration, and the two exports."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.operators.normalize import normalize, weather_records
from hazlake.plans.checks import base as b
from hazlake.plans.checks.payload_checks import _sql_hits, _SQL_TS, posts, tweet_pages
from hazlake.plans.checks.report_checks import _SPLIT
from hazlake.plans.checks.sensor_checks import SQL_FEATURES
from hazlake.plans.collect import collect_texts
from hazlake.plans.lake import Lake
from hazlake.session import shared_dir
from hazlake.sources import bronze, tables
from hazlake.sources.payloads import as_parsed
from hazlake.taxonomy import Taxonomy


@b.check(_SPLIT + """
SELECT lake_id, text, CAST(to_json(keywords_hit) AS VARCHAR) AS keywords_hit, hazard_type, label_confidence, split FROM export""")
def export_ml_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled dataset written as CSV by the job, and read back."""
    home = shared_dir(spark)
    lake = Lake(spark, f"{home}/raw", f"{home}/lake")
    tables.insert_or_ignore(b.doc_lake(spark, folder), lake.store_dir, "lake_records")
    return lake.export_ml(f"{home}/out", format="csv").select(
        "lake_id", "text", "keywords_hit", "hazard_type", "label_confidence", "split"
    )


_KINDS = Taxonomy(hazards=tuple((f"H{i}", (f"kind{i}",)) for i in range(9)), critical=("sos",), warning=("ther",))


@b.check(SQL_FEATURES + f"""
SELECT location_name, concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), CASE WHEN us % 1000000 <> 0 THEN strftime(ts, '.%f') ELSE '' END, '+00:00') AS collected_at,
  {b.sql_r6('rainfall_72h_sum')} AS rainfall_72h_sum, {b.sql_r6('temp_change_24h')} AS temp_change_24h,
  consecutive_rain_readings::BIGINT AS consecutive_rain_readings, hazard_within_24h::BIGINT AS hazard_within_24h, upcoming_hazard_type
FROM features""")
def export_sensor_job(spark: SparkSession, folder: str) -> DataFrame:
    """Readings and hazard texts through the store and the export job."""
    home = shared_dir(spark)
    lake = Lake(spark, f"{home}/raw", f"{home}/lake")
    readings = weather_records(as_parsed(b.event_readings(spark, folder), "weather"))
    tables.insert_or_ignore(readings, lake.store_dir, "weather_records")
    place = F.concat(F.lit("loc_"), (F.col("user_id") % 10).cast("string"))
    none = F.lit(None).cast("double")
    texts = b.load(spark, folder, "events").filter("event_type = 'error'").select(
        F.lit("rss").alias("source_type"), F.col("event_id").cast("string").alias("record_id"),
        b.iso_micros(F.col("ts")).alias("collected_at"),
        F.concat(F.lit("kind"), (F.col("event_id") % 9).cast("string")).alias("text"),
        F.struct(place.alias("name"), none.alias("lat"), none.alias("lon")).alias("location"),
    )
    tables.insert_or_ignore(normalize(as_parsed(texts, "text"), _KINDS), lake.store_dir, "lake_records")
    out = lake.export_sensor_features(f"{home}/out")
    return out.select(
        "location_name", "collected_at", b.r6(F.col("rainfall_72h_sum")).alias("rainfall_72h_sum"),
        b.r6(F.col("temp_change_24h")).alias("temp_change_24h"),
        F.col("consecutive_rain_readings").cast("bigint").alias("consecutive_rain_readings"),
        F.col("hazard_within_24h").cast("bigint").alias("hazard_within_24h"), "upcoming_hazard_type",
    )


@b.check(b.sql_lake() + """
SELECT 'lake_records' AS tbl, source_type, record_id, text, lake_id, hazard_type FROM lake
UNION ALL SELECT 'raw_records', source_type, record_id, text, NULL, NULL FROM lake""")
def migrate_job(spark: SparkSession, folder: str) -> DataFrame:
    """An empty store filled from landed lines and silver folders, twice."""
    home = shared_dir(spark)
    records = b.doc_records(spark, folder).drop("doc_id").withColumn("source", F.lower("source_type"))
    bronze.append_bronze(records, f"{home}/raw", F.substring("collected_at", 1, 10))
    lake = Lake(spark, f"{home}/raw", f"{home}/lake", b.TERMS_WHOLE)
    tables.write_silver(b.doc_lake(spark, folder), lake.silver_dir)
    lake.migrate()
    lake.migrate()
    return lake.db_query(
        "SELECT 'lake_records' AS tbl, source_type, record_id, text, lake_id, hazard_type FROM lake_records "
        "UNION ALL SELECT 'raw_records', source_type, record_id, text, NULL, NULL FROM raw_records"
    )


_AS_OF = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)


@b.check(f"""
WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS id, {_SQL_TS} AS made FROM documents UNION ALL SELECT concat('r', doc_id), {_SQL_TS} FROM documents),
p AS (SELECT doc_id, source, text, {_SQL_TS} + CASE WHEN doc_id % 2 = 0 THEN INTERVAL 500 MILLISECOND ELSE INTERVAL 0 SECOND END AS made FROM documents),
listed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY made DESC, CAST(doc_id AS VARCHAR)) AS n, concat('Post ', doc_id, ' ', text) AS body FROM p)
SELECT 'all' AS taken, 'twitter' AS source_type, id AS record_id FROM t WHERE made >= TIMESTAMP '2024-01-23 12:00:00'
UNION ALL SELECT 'all', 'reddit', CAST(doc_id AS VARCHAR) FROM listed WHERE made >= TIMESTAMP '2024-01-23 12:00:00' AND {_sql_hits('body')} <> ''
UNION ALL SELECT 'capped', source_type, record_id FROM (
  SELECT 'twitter' AS source_type, id AS record_id, row_number() OVER (ORDER BY made DESC, id) AS n FROM t WHERE made >= TIMESTAMP '2024-01-23 12:00:00'
) WHERE n <= 50
UNION ALL SELECT 'capped', 'reddit', CAST(doc_id AS VARCHAR) FROM listed
WHERE n <= 10 AND made >= TIMESTAMP '2024-01-23 12:00:00' AND {_sql_hits('body')} <> ''""")
def collect_job(spark: SparkSession, folder: str) -> DataFrame:
    """Landed tweets and posts of the last week, unique and relevant: all of them, and with caps asked for."""
    landing = f"{shared_dir(spark)}/landing"
    b.land(tweet_pages(spark, folder).select("payload"), f"{landing}/twitter")
    b.land(posts(spark, folder).select("payload"), f"{landing}/reddit")
    whole = collect_texts(spark, landing, _AS_OF, 7, b.KEYWORDS)
    capped = collect_texts(spark, landing, _AS_OF, 7, b.KEYWORDS, max_tweets=50, max_posts=10)

    def taken(name: str, found: dict[str, DataFrame]) -> DataFrame:
        return found["twitter"].unionByName(found["reddit"]).select(F.lit(name).alias("taken"), "source_type", "record_id")

    return taken("all", whole).unionByName(taken("capped", capped))
