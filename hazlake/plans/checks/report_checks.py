"""Statistics and quality reports."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.operators import ml_export, reports
from hazlake.operators.normalize import bronze_shape
from hazlake.operators.ranges import labelled_text
from hazlake.plans.checks import base as b
from hazlake.plans.checks.text_checks import _sql_clean, mixed_lines, sql_confidence
from hazlake.session import stage
from hazlake.sources.bronze import parse_lines

_LAKE = b.sql_lake()


@b.check(_LAKE + """
SELECT source_type, date_partition, count(*)::BIGINT AS records, count(DISTINCT hazard_type)::BIGINT AS hazard_types,
  count(*) FILTER (hazard_severity = 'CRITICAL')::BIGINT AS critical, count(*) FILTER (hazard_severity = 'WARNING')::BIGINT AS warning,
  count(DISTINCT location_name)::BIGINT AS locations
FROM lake GROUP BY source_type, date_partition ORDER BY date_partition DESC, source_type""")
def lake_stats(spark: SparkSession, folder: str) -> DataFrame:
    return reports.lake_stats(b.doc_lake(spark, folder))


@b.check(_LAKE + """
SELECT hazard_type, hazard_severity, count(*)::BIGINT AS records, min(date_partition) AS first_seen, max(date_partition) AS last_seen
FROM lake WHERE hazard_type IS NOT NULL GROUP BY hazard_type, hazard_severity ORDER BY records DESC, hazard_type, hazard_severity""")
def hazard_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hazard_summary(b.doc_lake(spark, folder))


@b.check(_LAKE + """, t AS (
SELECT count(*)::BIGINT AS total, count(text)::BIGINT AS with_text, count(lat)::BIGINT AS with_geo, count(hazard_type)::BIGINT AS labeled,
  count(*) FILTER (text IS NOT NULL AND hazard_type IS NOT NULL)::BIGINT AS labeled_with_text,
  count(*) FILTER (record_id = '')::BIGINT AS empty_record_id FROM lake)
SELECT *, 100 * with_text // greatest(total, 1) AS with_text_pct, 100 * with_geo // greatest(total, 1) AS with_geo_pct,
  100 * labeled // greatest(total, 1) AS labeled_pct FROM t""")
def totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.totals(b.doc_lake(spark, folder))


@b.check(_LAKE + """
SELECT hazard_type, hazard_severity, count(*)::BIGINT AS records FROM lake WHERE hazard_type IS NOT NULL
GROUP BY ALL ORDER BY hazard_type, hazard_severity""")
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_distribution(b.doc_lake(spark, folder))


@b.check(_LAKE + """
SELECT source_type, count(*)::BIGINT AS records, count(hazard_type)::BIGINT AS labeled, round(100.0 * count(text) / count(*), 1)::DOUBLE AS text_pct
FROM lake GROUP BY source_type ORDER BY records DESC, source_type""")
def source_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return reports.source_coverage(b.doc_lake(spark, folder))


@b.check(_LAKE + " SELECT min(date_partition) AS first_date, max(date_partition) AS last_date FROM lake")
def date_range(spark: SparkSession, folder: str) -> DataFrame:
    return reports.date_range(b.doc_lake(spark, folder))


@b.check("WITH " + b.SQL_READINGS + """
SELECT location_name, count(*)::BIGINT AS readings, min(date_partition) AS first_date, max(date_partition) AS last_date
FROM readings GROUP BY location_name ORDER BY readings DESC, location_name""")
def sensor_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sensor_coverage(b.event_readings(spark, folder))


@b.check(_LAKE + """, n AS (SELECT hazard_type, count(*) AS records FROM lake WHERE hazard_type IS NOT NULL GROUP BY hazard_type
  UNION ALL SELECT 'Z', 0)
SELECT hazard_type, sum(records)::BIGINT AS records FROM n GROUP BY hazard_type
HAVING sum(records) < (SELECT count(*) / 5 FROM documents) ORDER BY hazard_type""")
def low_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Classes below a fifth of the records, and one class that never occurs."""
    records = b.doc_lake(spark, folder)
    fifth = b.load(spark, folder, "documents").select((F.count("*") / 5).alias("n")).scalar()
    return reports.low_sample_classes(records, fifth, expected=["Z"])


@b.check(_LAKE + " SELECT source_type, count(*)::BIGINT AS records FROM lake GROUP BY ROLLUP (source_type)")
def collector_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.collector_summary(b.doc_lake(spark, folder))


@b.check("""
SELECT coalesce(CASE event_id % 8 WHEN 0 THEN 'weather' WHEN 1 THEN 'media' WHEN 2 THEN 'text' WHEN 3 THEN 'text' WHEN 7 THEN 'text' END, 'error') AS shape,
  count(*)::BIGINT AS records FROM events GROUP BY ALL""")
def migration_counters(spark: SparkSession, folder: str) -> DataFrame:
    shape = F.coalesce(bronze_shape(), F.lit("error")).alias("shape")
    return parse_lines(mixed_lines(spark, folder)).groupBy(shape).agg(F.count("*").alias("records"))


# -- labelled text export --------------------------------------------------------

_SPLIT = _LAKE + f""", clean AS (
  SELECT * REPLACE ({_sql_clean('text')} AS text) FROM lake WHERE text IS NOT NULL AND hazard_type IS NOT NULL
), kept AS (SELECT * FROM clean WHERE text IS NOT NULL
), days AS (SELECT list(DISTINCT date_partition ORDER BY date_partition) AS d FROM kept
), cut AS (SELECT d[greatest(1, floor(len(d) * 0.8::DOUBLE))::INT] AS train_end, d[greatest(1, floor(len(d) * (0.8::DOUBLE + 0.1::DOUBLE)))::INT] AS val_end FROM days
), peaks AS (SELECT source_type AS s, max(engagement_score) AS peak FROM kept GROUP BY ALL
), export AS (
  SELECT kept.* REPLACE (CASE WHEN peak > 0 THEN engagement_score / peak ELSE engagement_score END AS engagement_score),
    {sql_confidence('text', 'keywords_hit')} AS label_confidence,
    CASE WHEN date_partition <= (SELECT train_end FROM cut) THEN 'train' WHEN date_partition <= (SELECT val_end FROM cut) THEN 'val' ELSE 'test' END AS split
  FROM kept JOIN peaks ON s = source_type
)"""


@b.check(_SPLIT + " SELECT lake_id, source_type, " + b.sql_r6("engagement_score") + " AS engagement_score FROM export")
def engagement_scale(spark: SparkSession, folder: str) -> DataFrame:
    clean = ml_export.cleaned(b.doc_lake(spark, folder))
    return ml_export.scale_engagement(clean).select("lake_id", "source_type", b.r6(F.col("engagement_score")).alias("engagement_score"))


@b.check(_SPLIT + " SELECT date_partition, split, count(*)::BIGINT AS records FROM export GROUP BY ALL")
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    clean = ml_export.cleaned(b.doc_lake(spark, folder))
    return ml_export.temporal_split(clean).groupBy("date_partition", "split").agg(F.count("*").alias("records"))


@b.check(_SPLIT + """
SELECT lake_id, source_type, date_partition, text, array_to_string(keywords_hit, '|') AS keywords_hit, hazard_type, hazard_severity,
  location_name, lat, lon, """ + b.sql_r6("engagement_score") + """ AS engagement_score, language, label_confidence, split,
  CAST(NULL AS DOUBLE) AS rainfall_mm
FROM export""")
def ml_export_rows(spark: SparkSession, folder: str) -> DataFrame:
    out = ml_export.finish(stage(ml_export.cleaned(b.doc_lake(spark, folder))))
    return out.withColumns(
        {"keywords_hit": F.array_join("keywords_hit", "|"), "engagement_score": b.r6(F.col("engagement_score"))}
    ).drop("temperature_c", "humidity_pct", "wind_speed_ms", "pressure_hpa")


@b.check(_SPLIT + " SELECT split, count(*)::BIGINT AS records FROM export GROUP BY ALL")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.split_counts(ml_export.ml_dataset(b.doc_lake(spark, folder), train=0.8, val=0.1))


@b.check(_LAKE + """
SELECT lake_id, date_partition, hazard_type FROM lake
WHERE text IS NOT NULL AND hazard_type IN ('A', 'C') AND date_partition >= '2024-01-05' AND date_partition <= '2024-01-20'""")
def export_filter(spark: SparkSession, folder: str) -> DataFrame:
    return labelled_text(b.doc_lake(spark, folder), ["A", "C"], "2024-01-05", "2024-01-20").select(
        "lake_id", "date_partition", "hazard_type"
    )
