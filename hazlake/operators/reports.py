"""Statistics and quality reports over silver and bronze tables.

All are hash aggregations: Spark aggregates inside each map task first, so the
shuffle carries one row per task and group however skewed the groups are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazlake.taxonomy import LOW_SAMPLE_MIN


def _count_if(test: Column, name: str) -> Column:
    return F.count_if(test).alias(name)


def lake_stats(lake: DataFrame) -> DataFrame:
    return (
        lake.groupBy("source_type", "date_partition")
        .agg(
            F.count("*").alias("records"),
            F.count_distinct("hazard_type").alias("hazard_types"),
            _count_if(F.col("hazard_severity") == "CRITICAL", "critical"),
            _count_if(F.col("hazard_severity") == "WARNING", "warning"),
            F.count_distinct("location_name").alias("locations"),
        )
        .orderBy(F.desc("date_partition"), "source_type")
    )


def hazard_summary(lake: DataFrame) -> DataFrame:
    return (
        lake.filter(F.col("hazard_type").isNotNull())
        .groupBy("hazard_type", "hazard_severity")
        .agg(
            F.count("*").alias("records"),
            F.min("date_partition").alias("first_seen"),
            F.max("date_partition").alias("last_seen"),
        )
        .orderBy(F.desc("records"), "hazard_type", "hazard_severity")
    )


def totals(lake: DataFrame) -> DataFrame:
    """Counts with integer percents of the total; zeros for an empty lake."""
    text, hazard = F.col("text").isNotNull(), F.col("hazard_type").isNotNull()
    counts = lake.agg(
        F.count("*").alias("total"),
        _count_if(text, "with_text"),
        _count_if(F.col("lat").isNotNull(), "with_geo"),
        _count_if(hazard, "labeled"),
        _count_if(text & hazard, "labeled_with_text"),
        _count_if(F.col("record_id") == "", "empty_record_id"),
    )
    base = F.greatest(F.col("total"), F.lit(1))
    percents = {
        f"{name}_pct": F.floor(100 * F.col(name) / base).cast("bigint")
        for name in ("with_text", "with_geo", "labeled")
    }
    return counts.withColumns(percents)


def class_distribution(lake: DataFrame) -> DataFrame:
    return (
        lake.filter(F.col("hazard_type").isNotNull())
        .groupBy("hazard_type", "hazard_severity")
        .agg(F.count("*").alias("records"))
        .orderBy("hazard_type", "hazard_severity")
    )


def source_coverage(lake: DataFrame) -> DataFrame:
    return (
        lake.groupBy("source_type")
        .agg(
            F.count("*").alias("records"),
            _count_if(F.col("hazard_type").isNotNull(), "labeled"),
            F.round(100.0 * F.count_if(F.col("text").isNotNull()) / F.count("*"), 1).alias("text_pct"),
        )
        .orderBy(F.desc("records"), "source_type")
    )


def date_range(lake: DataFrame) -> DataFrame:
    return lake.agg(
        F.min("date_partition").alias("first_date"), F.max("date_partition").alias("last_date")
    )


def sensor_coverage(weather: DataFrame) -> DataFrame:
    return (
        weather.groupBy("location_name")
        .agg(
            F.count("*").alias("readings"),
            F.min("date_partition").alias("first_date"),
            F.max("date_partition").alias("last_date"),
        )
        .orderBy(F.desc("readings"), "location_name")
    )


def low_sample_classes(
    lake: DataFrame, minimum: int | Column = LOW_SAMPLE_MIN, expected: list[str] | None = None
) -> DataFrame:
    """Classes with fewer than ``minimum`` records; ``expected`` adds classes that never occur."""
    counts = lake.filter(F.col("hazard_type").isNotNull()).groupBy("hazard_type").agg(
        F.count("*").alias("records")
    )
    if expected:
        zeros = lake.sparkSession.createDataFrame([(c, 0) for c in expected], "hazard_type string, records long")
        counts = counts.unionByName(zeros).groupBy("hazard_type").agg(F.sum("records").alias("records"))
    return counts.filter(F.col("records") < minimum).orderBy("hazard_type")


def split_counts(export: DataFrame) -> DataFrame:
    return export.groupBy("split").agg(F.count("*").alias("records"))


def collector_summary(records: DataFrame, by: str = "source_type") -> DataFrame:
    """Records per source with a grand total (null source)."""
    return records.rollup(by).agg(F.count("*").alias("records"))
