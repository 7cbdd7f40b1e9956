"""Landed API payloads to bronze, then the full run into the lake."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazlake import taxonomy as tx
from hazlake.functions.once import once
from hazlake.operators import media as media_ops
from hazlake.operators.dedupe import cap_per_group, first_arrival, lookback
from hazlake.operators.reports import collector_summary
from hazlake.plans.lake import Lake
from hazlake.session import Scratch, path_exists, stage
from hazlake.sources import bronze, payloads

TEXT_SOURCES = ["twitter", "reddit", "news_api", "rss"]


def _landed(spark: SparkSession, landing_dir: str, source: str) -> DataFrame | None:
    path = f"{landing_dir}/{source}"
    return spark.read.text(path).withColumnRenamed("value", "payload") if path_exists(spark, path) else None


def _unique_recent(records: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """One record per id, of those not known to be older than the lookback; with ``_created``."""
    timed = records.withColumn("_created", F.try_to_timestamp("published_at"))
    recent = lookback(timed, "_created", as_of, days, keep_unknown=True)
    return first_arrival(recent, ["record_id"], [F.desc("_created")])


def collect_texts(
    spark: SparkSession,
    landing_dir: str,
    as_of: datetime,
    days: int = tx.LOOKBACK_DAYS,
    keywords=tx.DISASTER_KEYWORDS,
    max_tweets: int | None = None,
    max_posts: int | None = None,
    body_chars: int | None = None,
) -> dict[str, DataFrame]:
    """Text records by source from what has landed: recent and unique per source.

    ``max_tweets`` and ``max_posts`` (per subreddit) cap what is taken, newest
    first, and ``body_chars`` the length of an article's body, where one asks for that.
    """
    stamp = F.lit(as_of.isoformat())
    out = {}
    tweets = _landed(spark, landing_dir, "twitter")
    if tweets is not None:
        records = _unique_recent(payloads.parse_tweets(tweets, stamp, "payload", keywords), as_of, days)
        if max_tweets is not None:
            records = cap_per_group(records, "source_name", max_tweets, [F.desc("_created"), F.col("record_id")])
        out["twitter"] = records.drop("_created")
    posts = _landed(spark, landing_dir, "reddit")
    if posts is not None:
        # The cap is on posts seen, not on relevant ones: it comes before the keyword test.
        seen = once(posts, {"p": F.from_json("payload", "id string, subreddit string, created_utc double")})
        seen = seen.select("payload", "p.id", "p.subreddit", F.timestamp_micros((F.col("p.created_utc") * 1_000_000).cast("bigint")).alias("created"))
        newest = [F.desc("created"), F.col("id")]
        listed = first_arrival(seen, ["id"], newest)
        if max_posts is not None:
            listed = cap_per_group(listed, "subreddit", max_posts, newest)
        recent = lookback(listed, "created", as_of, days).select("payload")
        out["reddit"] = payloads.parse_reddit(recent, stamp, "payload", keywords)
    articles = _landed(spark, landing_dir, "news_api")
    if articles is not None:
        records = payloads.parse_news(articles, stamp, "payload", keywords)
        out["news_api"] = _unique_recent(records, as_of, days).drop("_created")
    if path_exists(spark, f"{landing_dir}/rss"):
        pages_dir = f"{landing_dir}/pages"
        pages = spark.read.parquet(pages_dir) if path_exists(spark, pages_dir) else None
        entries = payloads.read_feed(spark, f"{landing_dir}/rss")
        # Unique before the page lookup, so that a link found in every feed is looked up once; staged, so
        # that feeds are read and parsed once although the lookup uses the entries twice.
        unique = stage(first_arrival(payloads.relevant_entries(entries, keywords), ["named"], [F.col("feed")]), "entries")
        out["rss"] = payloads.parse_rss(unique, stamp, pages, keywords, body_chars)
    return out


def collect_weather(spark: SparkSession, landing_dir: str, as_of: datetime) -> DataFrame | None:
    """Readings from landed lines ``{location_name, lat, lon, payload}``."""
    landed = _landed(spark, landing_dir, "weather")
    if landed is None:
        return None
    schema = "location_name string, lat double, lon double, payload string"
    rows = landed.select(F.from_json("payload", schema).alias("r")).select("r.*")
    return payloads.parse_weather(rows, F.lit(as_of.isoformat()))


def collect(
    spark: SparkSession, landing_dir: str, raw_dir: str, as_of: datetime,
    days: int = tx.LOOKBACK_DAYS, keywords=tx.DISASTER_KEYWORDS, media_dir: str | None = None,
    domains=tx.MEDIA_DOMAINS, only: list[str] | None = None, max_tweets: int | None = None, max_posts: int | None = None,
) -> DataFrame:
    """Append every landed source to bronze, then media found through the text records; returns counts by source."""
    day = F.lit(as_of.strftime("%Y-%m-%d"))
    found = dict(collect_texts(spark, landing_dir, as_of, days, keywords, max_tweets, max_posts))
    weather = collect_weather(spark, landing_dir, as_of)
    if weather is not None:
        found["weather"] = weather
    with Scratch(spark) as scratch:
        total = spark.createDataFrame([], "source_type string")
        for source, records in found.items():
            if only is None or source in only:
                total = total.unionByName(_save(scratch.stage(records), source, raw_dir, day))
        if media_dir and (only is None or "media" in only):
            texts = [bronze.load_source_day(spark, raw_dir, s, as_of.strftime("%Y-%m-%d")) for s in TEXT_SOURCES]
            wanted = media_ops.candidates(media_ops.harvest_urls(reduce(DataFrame.unionByName, texts)), domains)
            files = media_ops.landed_files(spark, media_dir)
            kept = scratch.stage(media_ops.media_records(wanted, files, F.lit(as_of.isoformat())))
            total = total.unionByName(_save(kept, "media", raw_dir, day))
        # At most one row per source and the total.
        counts = collector_summary(total).collect()
    return spark.createDataFrame(counts, "source_type string, records long")


def _save(records: DataFrame, source: str, raw_dir: str, day: Column) -> DataFrame:
    bronze.append_bronze(records.withColumn("source", F.lit(source)), raw_dir, day)
    return records.select(F.lit(source).alias("source_type"))


def full_run(
    lake: Lake, landing_dir: str, as_of: datetime, days: int = tx.LOOKBACK_DAYS,
    collect_only: bool = False, lake_only: bool = False, date: str | None = None, media_dir: str | None = None,
    max_tweets: int | None = None, max_posts: int | None = None, keywords=tx.DISASTER_KEYWORDS,
) -> dict[str, DataFrame | dict]:
    """Land, ingest, report."""
    out: dict[str, DataFrame | dict] = {}
    if not lake_only:
        out["collected"] = collect(lake.spark, landing_dir, lake.raw_dir, as_of, days, keywords, media_dir, max_tweets=max_tweets, max_posts=max_posts)
    if not collect_only:
        out["ingested"] = lake.run(date=date)
        out["stats"], out["hazard_summary"] = lake.stats(), lake.hazard_summary()
    return out
