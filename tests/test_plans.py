"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from hazlake.operators import dedupe, reports, sensor
from hazlake.plans.checks import QUERIES
from hazlake.plans.checks.base import doc_lake
from hazlake.sources import tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


NO_FILES = [
    n for n in QUERIES
    if not n.startswith(("stream_", "bronze_", "silver_", "insert_", "ingest_job", "search_index", "ml_export_rows", "export_", "migrate_"))
]


@pytest.mark.parametrize("name", NO_FILES)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)


def test_first_arrival_and_caps_shrink_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    for out in (dedupe.first_arrival(df, ["k"], [F.col("id")]), dedupe.cap_per_group(df, "k", 2, [F.col("id")])):
        text = plan(out)
        assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_features_shuffle_wide_rows_once(spark):
    """Every shuffle but one moves the narrow carry columns; no shuffle is keyed by place alone on readings."""
    readings = spark.createDataFrame(
        [], "location_name string, lat double, lon double, collected_at string, date_partition string, temperature_c double,"
        " humidity_pct double, wind_speed_ms double, wind_dir_deg double, rainfall_mm double, pressure_hpa double",
    )
    events = spark.createDataFrame([], "location_name string, ts timestamp, hazard_type string")
    text = plan(sensor.sensor_features(readings.repartition(2), events))
    assert len(re.findall(r"hashpartitioning\(location_name#\d+, slice#\d+L?, ", text)) == 1
    assert len(re.findall(r"hashpartitioning\(location_name#\d+, cell#\d+L?, ", text)) == 1


def test_silver_filters_reach_the_folders(spark, tmp_path):

    path = str(tmp_path / "silver")
    tables.write_silver(doc_lake(spark, FOLDER), path)
    text = plan(tables.read_silver(spark, path).filter("date = '2024-01-03' AND source = 'reddit' AND lat > 20").select("lake_id"))
    partition = re.search(r"PartitionFilters: \[([^\]]*)", text).group(1)
    assert "date" in partition and "source" in partition
    assert "GreaterThan(lat,20.0)" in text
    assert "text" not in re.search(r"ReadSchema: struct<([^>]*)", text).group(1)


def test_reports_aggregate_before_the_shuffle(spark):

    text = plan(reports.hazard_summary(doc_lake(spark, FOLDER)))
    assert "partial_count(1)" in text
