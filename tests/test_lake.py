"""Whole jobs over small folders: ingest, rerun, merge, exports, migration, collection."""

import json
import os
import struct
import zlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from hazlake import Lake
from hazlake.__main__ import _parser
from hazlake.operators import media as media_ops
from hazlake.plans.collect import collect, full_run
from hazlake.sources import bronze, tables
from hazlake.streaming import intake

TEXT = {
    "source_type": "twitter", "source_name": "twitter", "record_id": "1", "collected_at": "2024-03-01T21:00:00+00:00",
    "published_at": None, "url": "u", "text": "Flood in Assam, alert", "language": "en", "keywords_hit": ["Assam flood"],
    "location": {"name": "Assam", "lat": 26.5, "lon": 92.5}, "media_urls": [],
    "raw_payload": {"public_metrics": {"retweet_count": 2, "like_count": 3, "reply_count": 1, "quote_count": 1}},
}
READING = {
    "location_name": "Assam", "lat": 26.5, "lon": 92.5, "collected_at": "2024-03-01T20:00:00+00:00", "temperature_c": 21,
    "humidity_pct": 90, "wind_speed_ms": 1.5, "wind_dir_deg": 90, "rainfall_mm": 2.5, "pressure_hpa": 1006, "condition": "rain",
    "raw_payload": {"cod": 200},
}


def land(folder, source, date, *records):
    os.makedirs(f"{folder}/{source}", exist_ok=True)
    with open(f"{folder}/{source}/{date}.jsonl", "a", encoding="utf-8") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")


@pytest.fixture
def lake(spark, tmp_path):
    raw = str(tmp_path / "raw")
    land(raw, "twitter", "2024-03-01", TEXT, "", "{bad", {"foo": 1}, {**TEXT, "record_id": "2", "text": "Landslide", "keywords_hit": []})
    land(raw, "twitter", "2024-03-02", {**TEXT, "collected_at": "2024-03-02T01:00:00+00:00", "text": "again"})
    land(raw, "reddit", "2024-03-02", {**TEXT, "source_type": "Reddit", "collected_at": "2024-03-02T02:00:00+00:00", "raw_payload": {"score": 4, "num_comments": 2}})
    land(raw, "weather", "2024-03-01", READING, {**READING, "collected_at": "2024-03-01T20:30:00.5+00:00"}, READING)
    return Lake(spark, raw, str(tmp_path / "lake"))


def snapshot(lake):
    rows = lambda df: sorted(json.dumps(r.asDict(True), sort_keys=True) for r in df.collect())
    return {name: rows(lake.table(name)) for name in ("lake_records", "raw_records", "weather_records", "media_records")} | {
        "silver": rows(lake.lake()), "corpus": rows(lake.derived("corpus")),
    }


def test_ingest_twice_equals_once(lake):
    first = lake.run()
    assert first == {
        "loaded": 8, "normalized": 7, "skipped": 1, "malformed": 1, "partitions": 4, "written": 7, "inserted": 5,
    }
    once = snapshot(lake)
    assert len(once["silver"]) == 7 and len(once["lake_records"]) == 5
    assert (len(once["raw_records"]), len(once["weather_records"])) == (4, 2)
    assert lake.run()["inserted"] == 0
    assert snapshot(lake) == once
    kept = [r for r in lake.table("lake_records").collect() if (r["source_type"], r["record_id"]) == ("twitter", "1")]
    assert [r["text"] for r in kept] == ["Flood in Assam, alert"]


def test_narrow_ingest_merges_into_shared_folders(lake):
    land(lake.raw_dir, "twitter", "2024-03-03", {**TEXT, "record_id": "9", "collected_at": "2024-03-02T23:59:00+00:00"})
    lake.run()
    before = snapshot(lake)
    lake.run(date="2024-03-03")
    assert snapshot(lake) == before
    parts = {(r["date"], r["source"]) for r in tables.list_partitions(lake.spark, lake.silver_dir).collect()}
    assert ("2024-03-02", "twitter") in parts and len(parts) == 4


def test_migrate_fills_an_empty_store(lake, spark, tmp_path):
    lake.run()
    other = Lake(spark, lake.raw_dir, str(tmp_path / "lake2"))
    other.silver_dir = lake.silver_dir
    counts = other.migrate()
    assert counts == {"weather": 3, "media": 0, "error": 1, "raw": 5, "lake": 5, "cells": 5}
    assert snapshot(other)["lake_records"] == snapshot(lake)["lake_records"]
    assert other.migrate()["lake"] == 0
    assert [r["lake_id"] for r in other.search_text("landslide").collect()] == [
        r["lake_id"] for r in lake.search_text("landslide").collect()
    ]


def test_queries_and_reports(lake):
    lake.run()
    assert lake.query("SELECT count(*) n FROM lake WHERE source_type = :s", s="weather").first()["n"] == 3
    assert lake.db_query("SELECT count(*) n FROM weather_records").first()["n"] == 2
    assert lake.db_query("SELECT count(*) n FROM raw_records r JOIN lake_records l USING (source_type, record_id)").first()["n"] == 3
    assert lake.query_bbox(26.5, 26.5, 92.5, 92.5).count() == 5 and lake.query_bbox(0, 26.4, 0, 99).count() == 0
    assert lake.query_time_range("2024-03-02", "2024-03-02", "reddit", "FLOOD").count() == 1
    assert {r["source"]: r["records"] for r in lake.bronze_stats().filter("file_date IS NULL").collect()} == {
        "twitter": 5, "reddit": 1, "weather": 3, None: 9,
    }
    report = {name: df.collect() for name, df in lake.validate().items()}
    assert report["totals"][0]["total"] == 5 and report["totals"][0]["with_text_pct"] == 60
    assert [r["hazard_type"] for r in report["low_sample"]] == ["FLOOD", "LANDSLIDE"]
    assert [tuple(r) for r in lake.search_text("flood").select("source_type", "hazard_severity").collect()]


def test_exports(lake, tmp_path):
    lake.run()
    for kind in ("parquet", "csv"):
        out = lake.export_ml(str(tmp_path / f"ml_{kind}"), format=kind)
        assert len(out.columns) == 19 and out.count() == 3
        assert {r["hazard_type"]: r["split"] for r in out.collect()}["LANDSLIDE"] == "train"
        sensors = lake.export_sensor_features(str(tmp_path / f"sensors_{kind}"), format=kind)
        rows = sensors.orderBy("collected_at").collect()
        assert len(sensors.columns) == 25 and [r["hazard_within_24h"] for r in rows] == [1, 1]
        assert [r["collected_at"] for r in rows] == ["2024-03-01 20:00:00+00:00", "2024-03-01 20:30:00.500000+00:00"]
        assert [r["rainfall_24h_sum"] for r in rows] == [2.5, 5.0]
    assert lake.export_ml(str(tmp_path / "one"), hazard_types=["FLOOD"], end="2024-03-01").count() == 1


def test_empty_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "none"), str(tmp_path / "lake"))
    assert lake.stats().count() == 0 and lake.db_stats().count() == 0
    assert lake.run()["loaded"] == 0
    assert lake.search_text("flood").count() == 0 and lake.bronze_stats().count() == 0


def test_files_of_other_sources_are_not_opened(lake, spark):
    os.makedirs(f"{lake.raw_dir}/rss")
    with open(f"{lake.raw_dir}/rss/2024-03-01.jsonl.gz", "wb") as f:
        f.write(b"this is no archive")
    assert bronze.read_lines(spark, lake.raw_dir, source="weather", date="2024-03-01").count() == 3
    with pytest.raises(Exception):
        bronze.read_lines(spark, lake.raw_dir, source="rss").count()


def test_unfinished_index_batch_is_not_seen(lake, spark):
    lake.run()
    want = [tuple(r) for r in lake.search_text("flood").select("lake_id", "score").collect()]
    # Postings of a job that died before its corpus row was written.
    lost = lake.derived("postings").withColumn("insert", F.lit("lost"))
    tables.put(lost, f"{lake.store_dir}/postings", "bucket", "insert")
    assert [tuple(r) for r in lake.search_text("flood").select("lake_id", "score").collect()] == want


def test_rebuilt_index_finds_the_same(lake, spark):
    lake.run()
    want = [tuple(r) for r in lake.search_text("flood").select("lake_id", "score").collect()]
    lake.rebuild_index()
    assert [tuple(r) for r in lake.search_text("flood").select("lake_id", "score").collect()] == want


def test_source_day_raises_on_a_bad_line(lake, spark):
    assert bronze.load_source_day(spark, lake.raw_dir, "reddit", "2024-03-02").count() == 1
    assert bronze.load_source_day(spark, lake.raw_dir, "reddit", "2024-03-09").count() == 0
    with pytest.raises(Exception, match="malformed line"):
        bronze.load_source_day(spark, lake.raw_dir, "twitter", "2024-03-01").collect()


def png(width, height):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    rows = b"".join(b"\0" + b"\x7f" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_collect_and_full_run(spark, tmp_path):
    landing, raw, media_dir = (str(tmp_path / n) for n in ("landing", "raw", "media"))
    as_of = datetime(2024, 3, 8, 12, tzinfo=timezone.utc)
    post = {
        "id": "p1", "title": "Kerala flood", "selftext": "now", "score": 4, "num_comments": 2, "subreddit": "india", "author": None,
        "created_utc": as_of.timestamp() - 3600, "permalink": "/r/p1", "url": "https://ndtv.com/big.png", "is_self": False,
    }
    old = {**post, "id": "p0", "created_utc": as_of.timestamp() - 8 * 86400}
    off = {**post, "id": "p2", "title": "cats", "selftext": ""}
    tweet = {"id": "t1", "text": "Assam flood", "created_at": "2024-03-08T00:00:00.000Z", "attachments": {"media_keys": ["m"]}}
    page = {"data": [tweet], "includes": {"media": [{"media_key": "m", "preview_image_url": "https://ndtv.com/small.png"}]}}
    article = {"source": {"name": "n"}, "title": "Sikkim flood", "url": "https://x/1", "publishedAt": "2024-03-07T00:00:00Z"}
    weather = {"location_name": "Assam", "lat": 1.0, "lon": 2.0, "payload": json.dumps({"main": {"temp": 20}, "rain": {"1h": 40}, "weather": [{"description": "rain"}]})}
    for source, rows in {"reddit": [post, post, old, off], "twitter": [page], "news_api": [article], "weather": [weather]}.items():
        land(landing, source, "part", *rows)
    os.makedirs(f"{landing}/rss")
    with open(f"{landing}/rss/feed_a.xml", "w") as f:
        f.write(
            "<rss><channel><item><title>Flood India</title><description>s</description><link>https://x/2</link>"
            "<pubDate>Fri, 08 Mar 2024 10:00:00 +0530</pubDate><category>c</category></item>"
            "<item><title>Cats</title><link>https://x/3</link></item></channel></rss>"
        )
    spark.createDataFrame([("https://x/2", "<p>Body</p>")], "url string, html string").write.parquet(f"{landing}/pages")
    os.makedirs(f"{media_dir}/images")
    for url, size in (("https://ndtv.com/big.png", (640, 480)), ("https://ndtv.com/small.png", (20, 20))):
        name = spark.range(1).select(F.md5(F.lit(url).cast("binary"))).first()[0]
        with open(f"{media_dir}/images/{name}.png", "wb") as f:
            f.write(png(*size))
    with open(f"{media_dir}/images/broken.png", "wb") as f:
        f.write(b"nothing")

    files = {r["local_path"]: (r["width"], r["height"]) for r in media_ops.landed_files(spark, media_dir).collect()}
    assert sorted(files.values(), key=repr) == sorted([(640, 480), (20, 20), (None, None)], key=repr)

    lake = Lake(spark, raw, str(tmp_path / "lake"))
    done = full_run(lake, landing, as_of, media_dir=media_dir)
    counts = {r["source_type"]: r["records"] for r in done["collected"].collect()}
    assert counts == {"reddit": 1, "twitter": 1, "news_api": 1, "rss": 1, "weather": 1, "media": 1, None: 6}
    assert done["ingested"]["normalized"] == 6 and done["ingested"]["malformed"] == 0
    got = {r["source_type"]: r for r in lake.table("lake_records").collect()}
    assert got["reddit"]["engagement_score"] == 7.0 and got["reddit"]["hazard_type"] == "FLOOD"
    assert got["rss"]["text"] == "Flood India s Body" and got["rss"]["published_at"] == "2024-03-08T04:30:00+00:00"
    assert got["weather"]["weather_condition"] == "[CRITICAL RAINFALL] rain" and got["weather"]["hazard_severity"] == "CRITICAL"
    assert got["media"]["url"] == "https://ndtv.com/big.png" and got["media"]["record_id"] == "p1"
    assert got["news_api"]["location_name"] == "India" and got["twitter"]["media_urls"] == ["https://ndtv.com/small.png"]
    again = collect(spark, landing, raw, as_of, only=["weather"])
    assert {r["source_type"]: r["records"] for r in again.collect()} == {"weather": 1, None: 1}


def test_command_line_covers_every_job():
    for argv in (
        "ingest --date 2024-01-01 --source rss", "stats", "query x", "db-stats", "db-query x", "search x --limit 3",
        "bbox --min-lat 1 --max-lat 2 --min-lon 3 --max-lon 4", "export-ml --output o --hazard A,B --format csv", "migrate",
        "validate", "export-sensors --output o", "batch --days 3", "collect news", "stream --no-reddit --checkpoint c",
        "bronze-stats", "run --collect-only", "time-range --start a --end b",
    ):
        assert _parser().parse_args(argv.split()).command


def rows_of(days):
    return [{**TEXT, "record_id": f"late{i}", "collected_at": f"{day}T10:00:00+00:00", "text": f"flood number{i}"} for i, day in enumerate(days)]


def test_a_stream_keeps_rows_weeks_out_of_order_and_indexes_them(lake, spark, tmp_path):
    days = ["2024-01-30", "2024-01-31", "2024-01-10", "2024-01-11"]
    landing = tmp_path / "landing"
    landing.mkdir()
    for i, row in enumerate(rows_of(days)):
        path = landing / f"{i}.jsonl"
        path.write_text(json.dumps(row) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    lines = intake.stream_lines(spark, str(landing), files_per_trigger=1)
    for attempt in range(2):
        intake.start_store_sink(lines, lake, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
    assert sorted(r["date_partition"] for r in lake.table("lake_records").collect()) == sorted(days)
    assert lake.search_text("flood").count() == 4 and lake.search_text("number2").count() == 1
    assert lake.lake().count() == 4 and lake.table("raw_records").count() == 4
    assert lake.query_bbox(26, 27, 92, 93).count() == 4


@pytest.mark.parametrize("step", ["write_silver", "put", "write_keys", "insert_new", "_insert_bronze", "_upkeep", "_index"])
def test_what_a_dead_job_left_out_is_found_by_the_next(lake, monkeypatch, step):
    lake.run()
    land(lake.raw_dir, "rss", "2024-03-03", *[{**r, "source_type": "rss"} for r in rows_of(["2024-03-03"] * 3)])
    owner = tables if hasattr(tables, step) else Lake
    real = getattr(owner, step)

    def dies(*args, **kwargs):
        if step != "_upkeep":
            real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, step, dies)
    with pytest.raises(RuntimeError):
        lake.run()
    monkeypatch.setattr(owner, step, real)
    lake.run()
    assert lake.search_text("flood number1").count() == 1 and lake.search_text("number2").count() == 1
    assert lake.query_bbox(26, 27, 92, 93).filter("source_type = 'rss'").count() == 3
    assert lake.table("lake_records").filter("source_type = 'rss'").count() == 3
    for name in ("lake_records", "raw_records"):
        keys = tables.read_keys(lake.spark, lake.store_dir, name)
        assert keys.count() == keys.select("key").distinct().count() == lake.table(name).count()


def test_a_small_batch_reads_only_its_buckets_and_its_own_insert(lake, spark):
    lake.run()
    many = [{**r, "record_id": f"k{i}"} for i, r in enumerate(rows_of(["2024-03-05"] * 600))]
    land(lake.raw_dir, "rss", "2024-03-05", *[{**r, "source_type": "rss"} for r in many])
    lake.run()
    records = lake.table("lake_records")
    few = records.filter("record_id IN ('k1', 'k2', 'k3')")
    held = tables.stored_keys(few, lake.store_dir, "lake_records")
    assert held.count() == 3
    buckets = {f.split("bucket=")[1].split("/")[0] for f in held.inputFiles()}
    assert 1 <= len(buckets) <= 3 < tables.KEY_BUCKETS
    new = tables.insert_new(few.withColumn("record_id", F.concat("record_id", F.lit("x"))), lake.store_dir, "lake_records")
    assert tables.pending(spark, lake.store_dir, "lake_records", "index") == [new]
    files = tables.read_insert(spark, lake.store_dir, "lake_records", new).inputFiles()
    assert files and all(f"insert={new}" in f for f in files)
    lake._upkeep()
    assert tables.pending(spark, lake.store_dir, "lake_records", "index") == []
    assert tables.read_insert(spark, lake.store_dir, "lake_records", tables.insert_new(few, lake.store_dir, "lake_records")).count() == 0
    assert tables.pending(spark, lake.store_dir, "lake_records", "index") == []


def test_inserts_side_by_side_break_nothing(lake, spark):
    from concurrent.futures import ThreadPoolExecutor

    lake.run()
    few = lake.table("lake_records").limit(3)
    parts = [few.withColumn("record_id", F.concat(F.lit(f"p{i}-"), F.monotonically_increasing_id().cast("string"))) for i in range(6)]
    before = lake.table("lake_records").count()
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda p: tables.insert_new(p, lake.store_dir, "lake_records"), parts))
    assert lake.table("lake_records").count() == before + 18
    assert tables.read_keys(spark, lake.store_dir, "lake_records").count() == before + 18


def test_nothing_indexed_searches_to_nothing(lake):
    lake._index(lake.table("lake_records"), "none")
    assert lake.search_text("flood").count() == 0


def test_narrow_merge_reads_the_touched_folders_alone(lake, spark, capsys):
    lake.run()
    stored = tables.read_silver(spark, lake.silver_dir).filter(F.col("date").isin(["2024-03-02"])).filter(F.col("source").isin(["reddit"]))
    stored.explain("formatted")
    assert "date#" in capsys.readouterr().out.split("PartitionFilters")[1].splitlines()[0]
    assert len(stored.select(F.input_file_name()).distinct().collect()) == 1


def test_box_queries_use_the_stored_cells(lake, capsys):
    lake.run()
    found = lake.query_bbox(26, 27, 92, 93)
    assert found.count() == 5 and "lat_cell" not in found.columns
    found.explain("formatted")
    pushed = capsys.readouterr().out.split("PushedFilters")[1].splitlines()[0]
    assert "lat_cell" in pushed and "lon_cell" in pushed
