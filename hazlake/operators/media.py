"""From text records to the media worth keeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazlake import taxonomy as tx
from hazlake.functions.media import image_size, is_relevant_url, local_name, media_type, passes_size_gate, size_kb


def harvest_urls(records: DataFrame) -> DataFrame:
    """(url, source_record_id): distinct media links of records with a keyword hit.

    A link shared by many records keeps the smallest record id, found by a
    map-side minimum.
    """
    return (
        records.filter(F.size("keywords_hit") > 0)
        .select("record_id", F.explode("media_urls").alias("url"))
        .filter(F.length("url") > 0)
        .groupBy("url")
        .agg(F.min("record_id").alias("source_record_id"))
    )


def candidates(urls: DataFrame, domains=tx.MEDIA_DOMAINS, content_type: str | None = None) -> DataFrame:
    """Relevant links with ``media_type`` and the ``local_path`` they are stored under."""
    kind = media_type(F.col("url"), F.col(content_type) if content_type else None)
    typed = urls.filter(is_relevant_url(F.col("url"), domains)).withColumn("media_type", kind)
    return typed.filter(F.col("media_type").isNotNull()).withColumn(
        "local_path", local_name(F.col("url"), F.col("media_type"))
    )


def landed_files(spark: SparkSession, media_dir: str, max_bytes: int = tx.MAX_FILE_BYTES) -> DataFrame:
    """(local_path, length, width, height) of landed files; what is not an image, or no readable one, has no size.

    One listing gives all lengths. Only images within ``max_bytes`` are opened, the others' length already
    decides; their size comes from the header, nothing is decoded.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    relative = F.regexp_extract("path", r"((?:images|videos)/[^/]+)$", 1).alias("local_path")
    files = reader.load(media_dir).select(relative, "length")
    # The length filter reaches the scan: longer files are not read. Kinds are told apart by content, not by name.
    opened = reader.load(media_dir).filter(F.col("length") <= max_bytes).select(relative, image_size(F.col("content")).alias("size"))
    images = opened.filter("size IS NOT NULL").select("local_path", "size.width", "size.height")
    return files.join(images, "local_path", "left")


def media_records(wanted: DataFrame, files: DataFrame, collected_at: Column) -> DataFrame:
    """Candidates whose landed file passes the size gates, as media records."""
    found = wanted.join(files, "local_path")
    kept = found.filter(
        passes_size_gate(F.col("media_type"), F.col("length"), F.col("width"), F.col("height"))
    )
    return kept.select(
        F.col("url").alias("source_url"), "local_path", "media_type", collected_at.alias("collected_at"),
        "source_record_id", size_kb(F.col("length")).alias("file_size_kb"),
        F.when(F.col("media_type") == "image", F.col("width")).alias("width"),
        F.when(F.col("media_type") == "image", F.col("height")).alias("height"),
    )
