"""Time the headline queries; prints one JSON line.

``queries`` holds seconds per query on a warm JVM (second run), ``cold`` the
first run. The ``lake_*`` entries work on a lake ingested from the documents,
as a user of the stored tables would.
"""

from __future__ import annotations

import json
import os
import platform
import time

from pyspark.sql import functions as F

from hazlake import Lake
from hazlake.operators.search import Match
from hazlake.plans.checks import QUERIES, base
from hazlake.session import build_session, shared_dir
from hazlake.sources import bronze

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "hazard_classify", "keyword_hit_list", "normalize_text", "normalize_weather", "ingest_counters", "lake_stats",
    "hazard_summary", "totals", "dedupe_first", "new_versus_stored", "text_clean", "ml_export_rows", "sensor_features",
    "hazard_ahead", "search_bm25", "search_postings", "page_text_image", "parse_tweet", "parse_rss", "harvest_urls",
    "cap_per_source", "export_sensor_job", "stream_tweets", "stream_weather",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(CPUS)), "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm, cold = {}, {}

    def timed(name: str, action, times: int = 2) -> None:
        for i in range(times):
            begun = time.perf_counter()
            action()
            (cold if i == 0 else warm)[name] = round(time.perf_counter() - begun, 3)
        warm.setdefault(name, cold[name])

    for name in HEADLINE:
        timed(name, lambda: run(QUERIES[name](spark, FOLDER)))

    home = shared_dir(spark)
    records = base.doc_records(spark, FOLDER).drop("doc_id").withColumn("source", F.lower("source_type"))
    bronze.append_bronze(records, f"{home}/raw", F.substring("collected_at", 1, 10))
    lake = Lake(spark, f"{home}/raw", f"{home}/lake", base.TERMS_WHOLE)
    timed("lake_ingest", lake.run, times=1)
    timed("lake_reingest", lake.run, times=1)
    timed("lake_stats_stored", lambda: run(lake.db_stats()))
    timed("lake_search", lambda: run(lake.search_text("of thing with", 20)))
    match = Match("with", ("of the",), ("thi",), ("is on", "ouen"), ("sos",))
    timed("lake_search_match", lambda: run(lake.search_text(match, 20)))
    timed("lake_bbox", lambda: run(lake.query_bbox(12.5, 30.25, 70, 90.75)))
    timed("lake_time_range", lambda: run(lake.query_time_range("2024-01-03", "2024-01-05")))
    timed("lake_export_ml", lambda: lake.export_ml(f"{home}/ml"))

    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"), "cpus": CPUS, "machine": platform.platform(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
