"""What a batch costs: whole rows are shuffled once, silver files are only added, postings name records by number."""

import glob

from pyspark.sql import functions as F

from hazlake.operators.dedupe import numbered, picked
from hazlake.plans.checks import base as b
from hazlake.plans.lake import Lake
from hazlake.schemas import LAKE
from hazlake.sources import tables


def records(spark, ids, day="2024-01-05", source="reddit", text="the flood"):
    rows = spark.createDataFrame([(f"id{i}", source, f"{i}", f"{day}T00:00:00+00:00", day, text) for i in ids],
                                 "lake_id string, source_type string, record_id string, collected_at string, date_partition string, text string")
    return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LAKE.fields])


def test_merge_of_new_ids_leaves_files_alone(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(records(spark, range(3)), path)
    before = set(glob.glob(f"{path}/*/*/*.parquet"))
    tables.write_silver(records(spark, range(3, 5)), path, merge=True)
    assert before < set(glob.glob(f"{path}/*/*/*.parquet"))
    tables.write_silver(records(spark, range(4, 6), text="again").unionByName(records(spark, [9], "2024-01-06")), path, merge=True)
    held = {(r["lake_id"], r["date"], r["text"]) for r in tables.read_silver(spark, path).collect()}
    assert held == {(f"id{i}", "2024-01-05", "again" if i > 3 else "the flood") for i in range(6)} | {("id9", "2024-01-06", "the flood")}
    assert tables.read_silver(spark, path).count() == 7


def test_merge_replaces_records_without_a_source(spark, tmp_path):
    path = str(tmp_path / "silver")
    for ids in ([1, 2], [2, 3], [2, 3]):
        tables.write_silver(records(spark, ids, source=""), path, merge=True)
    assert sorted(r["lake_id"] for r in tables.read_silver(spark, path).collect()) == ["id1", "id2", "id3"]


def test_picked_by_number(spark):
    rows = numbered(spark.range(0, 70_000, 1, 3))
    chosen = rows.filter("id % 5 = 2")
    assert picked(rows, chosen, []).agg(F.count("*"), F.sum("id")).first() == chosen.agg(F.count("*"), F.sum("id")).first()
    assert picked(rows, chosen, [], keep=False).filter("id % 5 = 2").count() == 0
    assert picked(rows, chosen.limit(0), [], keep=False).count() == 70_000


def test_index_names_records_by_number(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "raw"), str(tmp_path / "lake"))
    for ids in (range(3), range(2, 5)):
        tables.insert_new(records(spark, ids), lake.store_dir, "lake_records")
        lake._upkeep()
    assert "lake_id" not in lake.derived("postings").columns and lake.derived("postings").count() == 10
    assert [r["lake_id"] for r in lake.search_text("flood").collect()] == [f"id{i}" for i in range(5)]


def test_insert_shuffles_no_text(spark, tmp_path):
    staged = spark.read.parquet(_written(numbered(records(spark, [1, 1, 2])), str(tmp_path / "staged")))
    insert = tables.insert_new(staged, str(tmp_path / "store"), "lake_records")
    assert tables.read_insert(spark, str(tmp_path / "store"), "lake_records", insert).count() == 2
    plan = picked(staged, staged.select("_row"), [])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_landed_files_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(b, "LANDED_ROWS", 10)
    lines = spark.range(0, 95, 1, 1).select(F.col("id").cast("string").alias("value"))
    assert b.land(lines, str(tmp_path / "a")) == 10 and b.land(lines, str(tmp_path / "b"), 4) == 10
    assert b.land(lines.limit(8), str(tmp_path / "c"), 4) == 4
    assert spark.read.text(str(tmp_path / "a")).count() == 95


def _written(df, path):
    df.write.parquet(path)
    return path
