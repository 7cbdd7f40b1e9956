"""Streams over landed files, run to the end of what has landed."""

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.plans.checks import base as b
from hazlake.plans.checks.payload_checks import TWEETS_SQL, _SQL_TS, _sql_hits, flat_text_records, posts, tweet_pages
from hazlake.plans.lake import Lake
from hazlake.session import shared_dir
from hazlake.sources import bronze
from hazlake.streaming import intake


def _landed(spark: SparkSession, records: DataFrame, home: str, batches: int, copies: int = 1) -> DataFrame:
    """Records landed as JSON line files, ``copies`` times each, streamed in so many batches.

    Files land in as many waves, one after the other. A hash deals rows and copies over the waves before
    lines are made of them, so that every wave holds a mix of all and nothing is shuffled for it.
    """
    path, files = f"{home}/landing", 0
    for wave in range(batches):
        dealt = [records.filter(F.pmod(F.xxhash64("record_id", F.lit(copy)), F.lit(batches)) == wave) for copy in range(copies)]
        lines = reduce(DataFrame.unionAll, dealt).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        files += b.land(lines, f"{path}/{wave}", -(-6 // batches))
    return intake.stream_lines(spark, path, -(-files // batches))


_STREAMED = """
SELECT lake_id, source_type, record_id, date_partition, hazard_type, hazard_severity, text FROM lake"""


@b.check(b.sql_lake() + _STREAMED)
def stream_normalize(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze lines streamed to silver records, written by the Parquet sink."""
    home = shared_dir(spark)
    records = b.doc_records(spark, folder).drop("doc_id")
    lines = _landed(spark, records, home, 3)
    query = (
        intake.stream_records(lines, b.TERMS_WHOLE).writeStream.format("parquet")
        .option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start(f"{home}/out")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{home}/out").select(
        "lake_id", "source_type", "record_id", "date_partition", "hazard_type", "hazard_severity", "text"
    )


@b.check(b.sql_lake() + _STREAMED)
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Every record lands twice, days of a month in any order, and the whole run is repeated; the store holds each once."""
    home = shared_dir(spark)
    records = b.doc_records(spark, folder).drop("doc_id")
    lines = _landed(spark, records, home, 2, copies=2)
    lake = Lake(spark, f"{home}/raw", f"{home}/lake", b.TERMS_WHOLE)
    for attempt in range(2):
        intake.start_store_sink(lines, lake, f"{home}/checkpoint{attempt}").awaitTermination()
    return lake.table("lake_records").select(
        "lake_id", "source_type", "record_id", "date_partition", "hazard_type", "hazard_severity", "text"
    )


@b.check(TWEETS_SQL)
def stream_tweets(spark: SparkSession, folder: str) -> DataFrame:
    """Tweet pages streamed into bronze by the intake job, read back as bronze lines."""
    return flat_text_records(_intake(spark, tweet_pages(spark, folder), "twitter"))


def _intake(spark: SparkSession, payloads: DataFrame, source: str) -> DataFrame:
    """Payloads landed for a source, streamed into bronze, read back as records."""
    home = shared_dir(spark)
    b.land(payloads.select(F.col("payload").alias("value")), f"{home}/landing/{source}", 4)
    started = intake.start_intake(
        spark, f"{home}/landing", f"{home}/raw", f"{home}/checkpoints", sources=(source,), poll=False, keywords=b.KEYWORDS,
        as_of=datetime(2024, 1, 30, 12, tzinfo=timezone.utc),
    )
    for query in started.values():
        query.awaitTermination()
    return bronze.load_bronze(spark, f"{home}/raw", source=source).select("rec.*")


@b.check(f"""
WITH p AS (SELECT *, concat('Post ', doc_id, ' ', text) AS body FROM documents UNION ALL SELECT *, concat('Post ', doc_id, ' ', text) FROM documents WHERE doc_id % 3 = 0)
SELECT CAST(doc_id AS VARCHAR) AS record_id, body AS text FROM p
WHERE {_sql_hits('body')} <> '' AND {_SQL_TS} + CASE WHEN doc_id % 2 = 0 THEN INTERVAL 500 MILLISECOND ELSE INTERVAL 0 SECOND END >= TIMESTAMP '2024-01-29 12:00:00'""")
def stream_reddit(spark: SparkSession, folder: str) -> DataFrame:
    """Polled posts of the last day; what a second poll brings again is appended again."""
    return _intake(spark, posts(spark, folder), "reddit").select("record_id", "text")


@b.check(f"""
SELECT concat('loc_', user_id % 10) AS location_name, value / 10 AS rainfall_mm,
  concat(CASE WHEN value / 10 >= 35 THEN '[CRITICAL RAINFALL] ' WHEN value / 10 >= 15 THEN '[WARNING RAINFALL] ' ELSE '' END, event_type) AS condition
FROM events""")
def stream_weather(spark: SparkSession, folder: str) -> DataFrame:
    body = F.struct(
        F.struct((F.col("value") / 10).alias("1h")).alias("rain"),
        F.array(F.struct(F.col("event_type").alias("description"))).alias("weather"),
    )
    landed = b.load(spark, folder, "events").select(
        F.to_json(
            F.struct(
                F.concat(F.lit("loc_"), (F.col("user_id") % 10).cast("string")).alias("location_name"), F.lit(1.0).alias("lat"),
                F.lit(2.0).alias("lon"), F.to_json(body).alias("payload"),
            )
        ).alias("payload")
    )
    return _intake(spark, landed, "weather").select("location_name", "rainfall_mm", "condition")
