"""The lake's own methods over a stored lake: validation, the full run, streams of several sources, queries, search after a stream."""


from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.plans.checks import base as b
from hazlake.plans.checks.find_checks import SEARCH_INDEX_SQL
from hazlake.plans.checks.job_checks import _AS_OF
from hazlake.plans.checks.payload_checks import TWEETS_SQL, _SQL_TS, _sql_hits, posts, tweet_pages
from hazlake.plans.collect import full_run
from hazlake.plans.lake import Lake
from hazlake.session import shared_dir
from hazlake.sources import bronze, tables
from hazlake.streaming import intake


def _lake(spark: SparkSession) -> Lake:
    home = shared_dir(spark)
    return Lake(spark, f"{home}/raw", f"{home}/lake", b.TERMS_WHOLE)


def _landed_lines(spark: SparkSession, folder: str, home: str, batches: int) -> DataFrame:
    """documents as JSON line files, in no order of time, streamed in so many batches."""
    records = b.doc_records(spark, folder).drop("doc_id")
    lines = records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    files = b.land(lines, f"{home}/lines", 2 * batches)
    return intake.stream_lines(spark, f"{home}/lines", -(-files // batches))


@b.check(b.sql_lake() + """, t AS (
SELECT count(*) AS total, count(text) AS with_text, count(lat) AS with_geo, count(hazard_type) AS labeled,
  count(*) FILTER (text IS NOT NULL AND hazard_type IS NOT NULL) AS labeled_with_text FROM lake)
SELECT 'totals' AS report, 'total' AS key, total::BIGINT AS value FROM t UNION ALL SELECT 'totals', 'with_text', with_text FROM t
UNION ALL SELECT 'totals', 'with_geo', with_geo FROM t UNION ALL SELECT 'totals', 'labeled', labeled FROM t
UNION ALL SELECT 'totals', 'labeled_with_text', labeled_with_text FROM t
UNION ALL SELECT 'class_distribution', concat(hazard_type, '|', hazard_severity), count(*) FROM lake WHERE hazard_type IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'source_coverage', concat(source_type, '|', count(hazard_type)), count(*) FROM lake GROUP BY source_type
UNION ALL SELECT 'date_range', concat(min(date_partition), '|', max(date_partition)), 1 FROM lake
UNION ALL SELECT 'low_sample', hazard_type, count(*) FROM lake WHERE hazard_type IS NOT NULL GROUP BY hazard_type HAVING count(*) < 20""")
def validate_job(spark: SparkSession, folder: str) -> DataFrame:
    """Every report of the validation over a stored lake, as (report, key, value)."""
    lake = _lake(spark)
    tables.insert_or_ignore(b.doc_lake(spark, folder), lake.store_dir, "lake_records")
    reports = lake.validate()
    totals = reports["totals"].select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in ("total", "with_text", "with_geo", "labeled", "labeled_with_text")]))
    )
    keyed = {
        "totals": totals,
        "class_distribution": reports["class_distribution"].select(F.concat_ws("|", "hazard_type", "hazard_severity").alias("key"), F.col("records").alias("value")),
        "source_coverage": reports["source_coverage"].select(F.concat_ws("|", "source_type", "labeled").alias("key"), F.col("records").alias("value")),
        "date_range": reports["date_range"].select(F.concat_ws("|", "first_date", "last_date").alias("key"), F.lit(1).cast("bigint").alias("value")),
        "low_sample": reports["low_sample"].select(F.col("hazard_type").alias("key"), F.col("records").alias("value")),
    }
    out = None
    for name, frame in keyed.items():
        rows = frame.select(F.lit(name).alias("report"), "key", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


_FULL = f"""
t AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id, {_SQL_TS} AS made FROM documents UNION SELECT concat('r', doc_id), {_SQL_TS} FROM documents),
p AS (SELECT doc_id, concat('Post ', doc_id, ' ', text) AS body, {_SQL_TS} + CASE WHEN doc_id % 2 = 0 THEN INTERVAL 500 MILLISECOND ELSE INTERVAL 0 SECOND END AS made FROM documents),
found AS (
  SELECT 'twitter' AS source_type, id AS record_id FROM t WHERE made >= TIMESTAMP '2024-01-23 12:00:00'
  UNION ALL SELECT 'reddit', CAST(doc_id AS VARCHAR) FROM p WHERE made >= TIMESTAMP '2024-01-23 12:00:00' AND {_sql_hits('body')} <> '')"""


@b.check("WITH" + _FULL + """
SELECT 'collected' AS step, source_type, count(*)::BIGINT AS records FROM found GROUP BY ROLLUP (source_type)
UNION ALL SELECT 'stored', source_type, count(*)::BIGINT FROM found GROUP BY source_type""")
def full_run_job(spark: SparkSession, folder: str) -> DataFrame:
    """Landed payloads collected, ingested and reported in one run: what was collected, and what the lake then holds."""
    lake = _lake(spark)
    landing = f"{shared_dir(spark)}/landing"
    b.land(tweet_pages(spark, folder).select("payload"), f"{landing}/twitter")
    b.land(posts(spark, folder).select("payload"), f"{landing}/reddit")
    done = full_run(lake, landing, _AS_OF, keywords=b.KEYWORDS)
    collected = done["collected"].select(F.lit("collected").alias("step"), "source_type", "records")
    stored = lake.db_query("SELECT 'stored' AS step, source_type, count(*) AS records FROM lake_records GROUP BY ALL")
    return collected.unionByName(stored)


@b.check(f"""
WITH p AS (SELECT *, concat('Post ', doc_id, ' ', text) AS body, {_SQL_TS} + CASE WHEN doc_id % 2 = 0 THEN INTERVAL 500 MILLISECOND ELSE INTERVAL 0 SECOND END AS made FROM documents),
all_posts AS (SELECT * FROM p UNION ALL SELECT * FROM p WHERE doc_id % 3 = 0), tweets AS ({TWEETS_SQL})
SELECT 'twitter' AS source, record_id, text FROM tweets
UNION ALL SELECT 'reddit', CAST(doc_id AS VARCHAR), body FROM all_posts WHERE {_sql_hits('body')} <> '' AND made >= TIMESTAMP '2024-01-29 12:00:00'""")
def stream_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources switched on and one off, all landed; the one that is off stays unread."""
    home = shared_dir(spark)
    for source, payloads in (("twitter", tweet_pages(spark, folder)), ("reddit", posts(spark, folder)), ("weather", posts(spark, folder))):
        b.land(payloads.select(F.col("payload").alias("value")), f"{home}/landing/{source}")
    started = intake.start_intake(
        spark, f"{home}/landing", f"{home}/raw", f"{home}/checkpoints", sources=("twitter", "reddit"), poll=False, keywords=b.KEYWORDS, as_of=_AS_OF,
    )
    for query in started.values():
        query.awaitTermination()
    return bronze.load_bronze(spark, f"{home}/raw").select("source", "rec.record_id", "rec.text")


@b.check(SEARCH_INDEX_SQL)
def search_after_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Records that came by a stream, searched through the index."""
    lake, home = _lake(spark), shared_dir(spark)
    lines = _landed_lines(spark, folder, home, 2)
    intake.start_store_sink(lines, lake, f"{home}/checkpoint").awaitTermination()
    return lake.search_text("of thing with", 20).select("lake_id", F.round("score", 6).alias("score"))


@b.check(b.sql_lake() + """
SELECT source_type, language, count(*)::BIGINT AS records, round(avg(lat) + 1e-9, 6) AS lat FROM lake WHERE source_type <> 'reddit' GROUP BY ALL""")
def sql_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    """SQL with a named value through ``Lake.query`` over written silver folders."""
    lake = _lake(spark)
    tables.write_silver(b.doc_lake(spark, folder), lake.silver_dir)
    return lake.query(
        "SELECT source_type, language, count(*) AS records, round(avg(lat) + 1e-9, 6) AS lat FROM lake WHERE source_type <> :skip GROUP BY ALL", skip="reddit",
    )


@b.check(b.sql_lake() + " SELECT lake_id, lat, lon FROM lake WHERE lat BETWEEN 12.5 AND 30.25 AND lon BETWEEN 70 AND 90.75")
def stored_bbox(spark: SparkSession, folder: str) -> DataFrame:
    """A box over the stored lake, whose row groups are pruned by grid cells."""
    lake = _lake(spark)
    tables.insert_or_ignore(b.doc_lake(spark, folder), lake.store_dir, "lake_records")
    return lake.query_bbox(12.5, 30.25, 70, 90.75).select("lake_id", "lat", "lon")
