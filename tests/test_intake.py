"""Intake streams side by side, and batches that are run again."""

import glob
import json
import os
from collections import Counter

from hazlake.sources import bronze
from hazlake.streaming import intake

KEYWORDS = ("flood",)


def land(folder, source, name, payloads):
    os.makedirs(f"{folder}/{source}", exist_ok=True)
    with open(f"{folder}/{source}/{name}", "w") as f:
        f.writelines(json.dumps(p) + "\n" for p in payloads)


def tweets(start, n):
    return [{"data": [{"id": str(i), "text": f"flood {i}", "created_at": "2024-03-08T00:00:00.000Z"}]} for i in range(start, start + n)]


def readings(start, n):
    body = json.dumps({"main": {"temp": 20}, "rain": {"1h": 1}, "weather": [{"description": "rain"}]})
    return [{"location_name": f"p{i}", "lat": 1.0, "lon": 2.0, "payload": body} for i in range(start, start + n)]


def run(spark, home, sources=("twitter", "weather")):
    started = intake.start_intake(
        spark, f"{home}/landing", f"{home}/raw", f"{home}/checkpoints", sources=sources, poll=False, keywords=KEYWORDS,
    )
    for query in started.values():
        query.awaitTermination()
        assert query.exception() is None


def stored(spark, home):
    rows = bronze.load_bronze(spark, f"{home}/raw").select("source", "rec.record_id", "rec.location_name").collect()
    return Counter((r["source"], r["record_id"] or r["location_name"]) for r in rows)


def test_sources_side_by_side_lose_and_break_nothing(spark, tmp_path):
    want = Counter()
    for i in range(6):
        land(f"{tmp_path}/landing", "twitter", f"{i}.json", tweets(10 * i, 10))
        land(f"{tmp_path}/landing", "weather", f"{i}.json", readings(10 * i, 10))
        want.update(("twitter", str(k)) for k in range(10 * i, 10 * i + 10))
        want.update(("weather", f"p{k}") for k in range(10 * i, 10 * i + 10))
        run(spark, tmp_path)
        assert stored(spark, tmp_path) == want


def test_a_batch_that_is_run_again_doubles_nothing(spark, tmp_path):
    land(f"{tmp_path}/landing", "twitter", "a.json", tweets(0, 5))
    run(spark, tmp_path, ("twitter",))
    land(f"{tmp_path}/landing", "twitter", "b.json", tweets(5, 5))
    run(spark, tmp_path, ("twitter",))
    want = stored(spark, tmp_path)
    assert len(want) == 10 and set(want.values()) == {1}
    # As after a failure between the write and the commit: the last batch is not known to be done.
    last = max(glob.glob(f"{tmp_path}/checkpoints/twitter/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    os.remove(f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc")
    run(spark, tmp_path, ("twitter",))
    assert stored(spark, tmp_path) == want


def test_a_fresh_checkpoint_is_a_stream_of_its_own(spark, tmp_path):
    land(f"{tmp_path}/landing", "twitter", "a.json", tweets(0, 3))
    run(spark, tmp_path, ("twitter",))
    os.rename(f"{tmp_path}/checkpoints", f"{tmp_path}/old")
    run(spark, tmp_path, ("twitter",))
    assert set(stored(spark, tmp_path).values()) == {2}


def test_one_source_and_day_read_their_folders_alone(spark, tmp_path):
    land(f"{tmp_path}/landing", "twitter", "a.json", tweets(0, 3))
    land(f"{tmp_path}/landing", "weather", "a.json", readings(0, 3))
    run(spark, tmp_path)
    day = bronze.read_lines(spark, f"{tmp_path}/raw").first()["file_date"]
    assert bronze.read_lines(spark, f"{tmp_path}/raw", "twitter", day).count() == 3
    assert bronze.read_lines(spark, f"{tmp_path}/raw", "weather").count() == 3
    assert bronze.read_lines(spark, f"{tmp_path}/raw", date=day).count() == 6
    assert bronze.read_lines(spark, f"{tmp_path}/raw", "twitter", "1999-01-01").count() == 0
