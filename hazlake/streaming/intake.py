"""Streams over landing folders.

Parsing and normalising are stateless projections, so a stream gives the same
rows as a batch over the same files. Every source and micro-batch writes bronze under a
root of its own, named by the query's id and the batch's number: sources run side by side,
and a batch that is run again after a failure replaces what it wrote. Repeats are dropped by the store's key
alone, however late they come, which also makes a replayed micro-batch
harmless; no row is ever too late.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hazlake import taxonomy as tx
from hazlake.operators.dedupe import lookback
from hazlake.operators.normalize import normalize
from hazlake.plans.lake import Lake
from hazlake.sources.bronze import append_bronze, parse_lines
from hazlake.sources.payloads import parse_reddit, parse_tweets, parse_weather

# How often a polled source is read. Tweets are pushed: their files are read as they land.
POLL_SECONDS = {"reddit": tx.REDDIT_POLL_SECONDS, "weather": tx.WEATHER_POLL_SECONDS}
# A poll of posts asks for the last day.
POLL_LOOKBACK_DAYS = {"reddit": 1}


def stream_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, pattern: str = "*"
) -> DataFrame:
    """Landed text lines of a folder, new files as they appear; column ``line``."""
    reader = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(F.btrim("value").alias("line")).filter("line <> ''")


def stream_records(lines: DataFrame, taxonomy: tx.Taxonomy = tx.DEFAULT) -> DataFrame:
    """Bronze lines to silver records."""
    return normalize(parse_lines(lines), taxonomy)


def _triggered(writer, seconds: int | None):
    return writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")


def start_store_sink(lines: DataFrame, lake: Lake, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Ingest every micro-batch of bronze ``lines`` as ``Lake.run`` does; ``seconds=None`` takes what is there and stops."""
    def ingest(batch: DataFrame, _epoch: int) -> None:
        lake.ingest(parse_lines(batch), merge=True)

    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(ingest)
    return _triggered(writer, seconds).start()


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps over restarts; a stream with a fresh checkpoint has a new one."""
    return spark.read.json(f"{checkpoint}/metadata", "id string").first()["id"]


def landed_parsers(collected_at: Column, keywords=tx.DISASTER_KEYWORDS) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Payload column ``line`` to bronze records, by source."""
    place = "location_name string, lat double, lon double, payload string"

    def weather(lines: DataFrame) -> DataFrame:
        landed = lines.select(F.from_json("line", place).alias("r")).select("r.*")
        return parse_weather(landed, collected_at)

    return {
        "twitter": lambda lines: parse_tweets(lines, collected_at, "line", keywords),
        "reddit": lambda lines: parse_reddit(lines, collected_at, "line", keywords),
        "weather": weather,
    }


def start_intake(
    spark: SparkSession,
    landing_dir: str,
    raw_dir: str,
    checkpoint_dir: str,
    sources: tuple[str, ...] = ("twitter", "reddit", "weather"),
    poll: bool = True,
    keywords=tx.DISASTER_KEYWORDS,
    lookback_days: dict[str, int] = POLL_LOOKBACK_DAYS,
    as_of: datetime | None = None,
) -> dict[str, StreamingQuery]:
    """One query per chosen source: landed payloads, parsed, appended to bronze.

    Each has its own checkpoint, so sources are switched on and off one by one.
    With ``poll=False`` every query takes what has landed and stops. A source in
    ``lookback_days`` keeps posts made within so many days before ``as_of``, by
    default the time of the batch; posts without a readable time are kept.
    """
    parsers = landed_parsers(F.lit(None).cast("string"), keywords)
    started = {}
    for source in sources:
        parsed = parsers[source](stream_lines(spark, f"{landing_dir}/{source}"))

        def save(batch: DataFrame, epoch: int, source: str = source) -> None:
            now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
            if source in lookback_days:
                made = batch.withColumn("_made", F.try_to_timestamp("published_at"))
                batch = lookback(made, "_made", as_of or datetime.now(timezone.utc), lookback_days[source], keep_unknown=True).drop("_made")
            stamped = batch.withColumns({"collected_at": now, "source": F.lit(source)})
            append_bronze(stamped, raw_dir, batch=f"{_query_id(batch.sparkSession, f'{checkpoint_dir}/{source}')}-{epoch}")

        writer = parsed.writeStream.option("checkpointLocation", f"{checkpoint_dir}/{source}").foreachBatch(save)
        seconds = POLL_SECONDS.get(source, 5) if poll else None
        started[source] = _triggered(writer, seconds).start()
    return started
