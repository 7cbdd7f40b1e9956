"""What comes again: rows that are stored as they are cost no write, others replace what they should."""

import glob
import json
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hazlake.functions.text import query_tokens
from hazlake.operators import search
from hazlake.plans.checks import base as b
from hazlake.plans.checks.stream_checks import _landed
from hazlake.plans.lake import Lake
from hazlake.sources import bronze, tables
from tests.test_batches import records

TWEET = {"source_type": "twitter", "record_id": "1", "collected_at": "2024-03-01T00:00:00+00:00", "text": "a flood", "location": {"name": "x", "lat": None, "lon": 5.0}}


def ingest(lake, *rows):
    lines = lake.spark.createDataFrame([(json.dumps(r),) for r in rows], "line string")
    return lake.ingest(bronze.parse_lines(lines), merge=True)


def silver(lake):
    return Counter((r["record_id"], r["lat"], r["lon"], r["text"]) for r in lake.lake().collect())


def test_a_batch_that_comes_again_writes_no_silver_file(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "raw"), str(tmp_path / "lake"))
    rows = [TWEET, {**TEXT_2, "record_id": "2"}, {**TEXT_2, "record_id": "2"}]
    assert ingest(lake, *rows)["inserted"] == 2
    before, files = silver(lake), set(glob.glob(f"{lake.silver_dir}/*/*/*.parquet"))
    counts = ingest(lake, *rows)
    assert counts["inserted"] == 0 and counts["written"] == 3
    assert set(glob.glob(f"{lake.silver_dir}/*/*/*.parquet")) == files and silver(lake) == before
    # One of the ids comes twice now, one has a value in another field, one is new.
    moved = {**TEXT_2, "record_id": "2", "location": {"name": "x", "lat": 5.0, "lon": None}}
    ingest(lake, TWEET, TWEET, moved, {**TWEET, "record_id": "3"})
    assert silver(lake) == {("1", None, 5.0, "a flood"): 2, ("2", 5.0, None, "rain"): 1, ("3", None, 5.0, "a flood"): 1}
    assert lake.table("lake_records").count() == lake.table("raw_records").count() == 3
    assert lake.derived("corpus").agg(F.sum("docs"), F.sum("tokens")).first() == search.corpus_stats(lake.table("lake_records")).first()


TEXT_2 = {**TWEET, "text": "rain"}


def test_marks_tell_moved_values_apart(spark, tmp_path):
    path = str(tmp_path / "silver")
    first = records(spark, [1]).withColumns({"published_at": F.lit("x"), "keywords_hit": F.array(F.lit("k"))})
    moved = records(spark, [1]).withColumns({"url": F.lit("x"), "media_urls": F.array(F.lit("k"))})
    for rows in (first, moved, moved):
        tables.write_silver(rows, path, merge=True)
        held = tables.read_silver(spark, path).select(*first.columns)
        assert held.count() == 1 and held.exceptAll(rows.select(*first.columns)).count() == 0


def test_postings_of_words_that_share_a_hash(spark, monkeypatch):
    texts = ["the Flood of the river, the flood", "b a b c a b", "", "éa ea river"]
    rows = spark.createDataFrame([(i, t, ["the flood", "sea"], "A", "b") for i, t in enumerate(texts)],
                                 "doc long, text string, keywords_hit array<string>, hazard_type string, location_name string")
    want = defaultdict(list)
    for i, text in enumerate(texts):
        for k, column in enumerate((text, "the flood sea", "A", "b")):
            words = [w for part in column.replace(",", " ").split() for w in query_tokens(part)]
            for at, word in enumerate(words):
                want[i, word].append(k * search.PLACE_STEP + at)
    for shared in (F.hash, F.length):
        monkeypatch.setattr(search.F, "hash", shared)
        found = search.postings(rows, ("doc",)).collect()
        assert len(found) == len(want) and {(r["doc"], r["token"]): r["places"] for r in found} == want
        assert all(r["freq"] == len(r["places"]) for r in found)
        assert search.postings_stats(search.postings(rows, ("doc",)), 4).first() == search.corpus_stats(rows).first()


def test_rows_and_copies_land_mixed_over_the_batches(spark, tmp_path):
    rows = b.doc_records(spark, "/root/testdata/sf0.001").drop("doc_id")
    _landed(spark, rows, str(tmp_path), 2, copies=2)
    waves = [spark.read.text(f"{tmp_path}/landing/{wave}") for wave in range(2)]
    held = [Counter(json.loads(r["value"])["record_id"] for r in wave.collect()) for wave in waves]
    assert held[0] + held[1] == Counter({r["record_id"]: 2 for r in rows.select("record_id").collect()})
    # Records that land twice in one batch, and records that land once in each.
    assert {1, 2} == set(held[0].values()) == set(held[1].values())
    assert all(glob.glob(f"{tmp_path}/landing/{wave}/part-*.gz") for wave in range(2))
