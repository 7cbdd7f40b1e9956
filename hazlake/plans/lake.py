"""The lake: ingest, reports, search, exports and migration over one folder.

Layout under ``lake_dir``: ``silver/date=/source=`` (as normalised), ``store/<table>/date=/insert=``
(one row per key) with ``store/keys``, ``store/inserts`` and ``store/done`` beside it (see ``sources/tables.py``),
and the text index: ``store/postings/bucket=/insert=`` and ``store/corpus/insert=``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazlake import taxonomy as tx
from hazlake.operators.dedupe import numbered
from hazlake.operators import ml_export, normalize as norm, ranges, reports, search, sensor
from hazlake.schemas import DERIVED
from hazlake.session import Scratch, path_exists
from hazlake.sources import bronze, tables

STORE_TABLES = ["lake_records", "raw_records", "weather_records", "media_records"]


class Lake:
    def __init__(self, spark: SparkSession, raw_dir: str, lake_dir: str, taxonomy: tx.Taxonomy = tx.DEFAULT):
        self.spark, self.raw_dir, self.taxonomy = spark, raw_dir, taxonomy
        self.silver_dir, self.store_dir = f"{lake_dir}/silver", f"{lake_dir}/store"

    # -- tables ---------------------------------------------------------------

    def lake(self) -> DataFrame:
        return tables.read_silver(self.spark, self.silver_dir)

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.store_dir, name)

    # -- ingest -----------------------------------------------------------------

    def run(self, date: str | None = None, source: str | None = None) -> dict[str, int]:
        """Bronze lines to silver and to the store; returns the counters.

        A run narrowed to a date or source merges into the folders it touches,
        because a file's records may belong to a folder other files share.
        """
        return self.ingest(bronze.load_bronze(self.spark, self.raw_dir, source, date), merge=bool(date or source))

    def ingest(self, parsed: DataFrame, merge: bool) -> dict[str, int]:
        """Parsed lines to silver, the store, its index and the bronze tables; returns the counters."""
        with Scratch(self.spark) as scratch:
            # Lines are parsed once and records normalised and labelled once; everything below reads staged columns.
            # They are staged by silver folder: this is the only time that whole rows are shuffled, and the only
            # copy of them. What a merge or an insert writes is settled on keys and marks.
            parsed = scratch.stage(_by_folder(norm.with_records(parsed, self.taxonomy)))
            counts = norm.ingest_counts(parsed, by_table=True).first().asDict()
            found = {shape: counts.pop(shape) for shape in norm.SHAPES}
            records = norm.records(parsed)
            tables.write_silver(records, self.silver_dir, merge=merge)
            insert = tables.insert_new(records, self.store_dir, "lake_records")
            self._insert_bronze(parsed, found)
            self._upkeep()
            inserted = tables.read_insert(self.spark, self.store_dir, "lake_records", insert).count()
            return {**counts, "written": counts["normalized"], "inserted": inserted}

    def _insert_bronze(self, parsed: DataFrame, found: dict[str, int]) -> None:
        """Fill the bronze tables that there are lines for; ``found`` counts lines by shape."""
        for shape, table, rows in (
            ("text", "raw_records", norm.raw_records),
            ("weather", "weather_records", norm.weather_records),
            ("media", "media_records", norm.media_records),
        ):
            if found.get(shape):
                tables.insert_new(rows(parsed), self.store_dir, table)

    def _upkeep(self) -> None:
        """Index the inserts that are not indexed yet, this job's and those of jobs that died after theirs.

        Which these are is read from folder names: neither stored records nor the index are read for it.
        """
        for insert in tables.pending(self.spark, self.store_dir, "lake_records", "index"):
            self._index(tables.read_insert(self.spark, self.store_dir, "lake_records", insert), insert)
            tables.mark_done(self.spark, self.store_dir, "index", insert)

    def _index(self, records: DataFrame, insert: str) -> None:
        """Add an insert's records to the text index.

        Searches see an insert only once its ``corpus`` row is there, which is written last, so a job
        that dies half-way leaves nothing counted twice; indexing it again replaces what it left.
        """
        named, path = F.lit(insert).alias("insert"), f"{self.store_dir}/postings"
        # Rows read without their numbers (``read_table``) cannot be looked up.
        records = records if "doc" in records.columns else records.withColumn("doc", F.lit(None).cast("bigint"))
        posts = search.in_buckets(search.postings(records, ("doc",))).select("*", named)
        tables.put(posts, path, "bucket", "insert")
        # Tokens are counted where they were written, texts are not cut again for it.
        written = tables.read_folders(self.spark, path, f"bucket=*/insert={insert}", DERIVED["postings"])
        stats = search.postings_stats(written, records.count())
        tables.put(stats.select("*", named), f"{self.store_dir}/corpus", "insert")

    def rebuild_index(self) -> None:
        """Replace the text index by a fresh one, for instance after rows were removed by hand."""
        # The corpus rows go first: without them no insert is seen.
        for name in ("corpus", "postings"):
            self.spark.createDataFrame([], DERIVED[name]).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.store_dir}/{name}")
        for insert in tables.pending(self.spark, self.store_dir, "lake_records", "nothing"):
            self._index(tables.read_insert(self.spark, self.store_dir, "lake_records", insert), insert)

    def _visible(self, name: str) -> DataFrame:
        """Rows of inserts that are indexed whole."""
        return self.derived(name).join(self.derived("corpus").select("insert"), "insert", "left_semi")

    def derived(self, name: str) -> DataFrame:
        """``postings`` or ``corpus``; empty when nothing was stored yet."""
        path, schema = f"{self.store_dir}/{name}", DERIVED[name]
        if path_exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    def migrate(self) -> dict[str, int]:
        """Fill the store and its indexes from existing bronze and silver files; a second run adds nothing."""
        with Scratch(self.spark) as scratch:
            parsed = scratch.stage(_by_folder(bronze.load_bronze(self.spark, self.raw_dir)))
            shape = F.coalesce(norm.bronze_shape(), F.lit("error")).alias("shape")
            found = {r["shape"]: r["count"] for r in parsed.groupBy(shape).count().collect()}
            self._insert_bronze(parsed, found)
            silver = tables.reload_silver(self.spark, self.silver_dir)
            insert = tables.insert_new(silver, self.store_dir, "lake_records")
            self._upkeep()
            inserted = tables.read_insert(self.spark, self.store_dir, "lake_records", insert)
            placed = F.count_if(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            rows = inserted.agg(F.count("*").alias("lake"), placed.alias("cells")).first()
            return {
                "raw": found.get("text", 0), "weather": found.get("weather", 0), "media": found.get("media", 0),
                "error": found.get("error", 0), "lake": rows["lake"], "cells": rows["cells"],
            }

    def unread_files(self) -> DataFrame:
        """Silver files that ``migrate`` skips, whole or in part."""
        return tables.unread_files(self.spark, self.silver_dir)

    # -- reports ------------------------------------------------------------------

    def stats(self) -> DataFrame:
        return reports.lake_stats(self.lake())

    def hazard_summary(self) -> DataFrame:
        return reports.hazard_summary(self.lake())

    def db_stats(self) -> DataFrame:
        return reports.lake_stats(self.table("lake_records"))

    def db_hazard_summary(self) -> DataFrame:
        return reports.hazard_summary(self.table("lake_records"))

    def validate(self) -> dict[str, DataFrame]:
        records = self.table("lake_records")
        return {
            "totals": reports.totals(records),
            "class_distribution": reports.class_distribution(records),
            "source_coverage": reports.source_coverage(records),
            "date_range": reports.date_range(records),
            "sensor_coverage": reports.sensor_coverage(self.table("weather_records")),
            "low_sample": reports.low_sample_classes(records),
        }

    def bronze_stats(self) -> DataFrame:
        return bronze.line_stats(bronze.read_lines(self.spark, self.raw_dir))

    # -- queries --------------------------------------------------------------------

    def query(self, sql: str, **args) -> DataFrame:
        """SQL over the view ``lake``."""
        self.lake().createOrReplaceTempView("lake")
        return self.spark.sql(sql, args=args or None)

    def db_query(self, sql: str, **args) -> DataFrame:
        """SQL over the four store tables; values go in as named parameters (``:name``)."""
        for name in STORE_TABLES:
            self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(sql, args=args or None)

    def search_text(self, match: search.Match | str, limit: int | None = 50) -> DataFrame:
        """Best records for plain words or a ``Match``, by the text index."""
        numbers = tables.read_numbers(self.spark, self.store_dir)
        hits = search.search_postings(self._visible("postings"), self.derived("corpus"), match, limit, numbers)
        return search.fetch(hits, self.table("lake_records"))

    def query_bbox(self, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> DataFrame:
        return ranges.bbox(tables.read_cells(self.spark, self.store_dir), min_lat, max_lat, min_lon, max_lon).drop(*ranges.CELLS)

    def query_time_range(
        self, start: str, end: str, source_type: str | None = None, hazard_type: str | None = None
    ) -> DataFrame:
        return ranges.time_range(self.table("lake_records"), start, end, source_type, hazard_type)

    # -- exports ----------------------------------------------------------------------

    def export_ml(
        self, output: str, hazard_types: list[str] | None = None, start: str | None = None,
        end: str | None = None, format: str = "parquet", train_ratio: float = 0.8, val_ratio: float = 0.1,
    ) -> DataFrame:
        """Write the labelled text dataset; returns what was written."""
        records = self.table("lake_records")
        with Scratch(self.spark) as scratch:
            # Cleaned once: the maxima and the split days are read from the staged columns.
            clean = scratch.stage(ml_export.cleaned(records, hazard_types=hazard_types, start=start, end=end))
            return _export(ml_export.finish(clean, train_ratio, val_ratio), output, format, "date_partition")

    def export_sensor_features(
        self, output: str, start: str | None = None, end: str | None = None,
        format: str = "parquet", warmup_days: int = 0,
    ) -> DataFrame:
        """Write the sensor features; returns what was written."""
        readings = sensor.readings_between(self.table("weather_records"), start, end, warmup_days)
        events = sensor.hazard_events(self.table("lake_records"))
        features = sensor.sensor_features(readings, events, output_from=start if warmup_days else None)
        return _export(features.withColumn("collected_at", _time_text(F.col("collected_at"))), output, format)


def _by_folder(parsed: DataFrame) -> DataFrame:
    """Parsed lines with a number each, those of a date and a source side by side."""
    folder = {"_date": F.substring("rec.collected_at", 1, 10), "_source": F.lower("rec.source_type")}
    named = parsed.select(*[c for c in ("shape", "rec", "lake") if c in parsed.columns]).withColumns(folder)
    return numbered(named.hint("rebalance", *map(F.col, folder)).drop(*folder))


def _time_text(ts: Column) -> Column:
    """``2024-01-01 00:00:00[.ffffff]+00:00``."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), fraction, F.lit("+00:00"))


def _export(df: DataFrame, output: str, format: str, sort: str | None = None) -> DataFrame:
    if format not in ("parquet", "csv"):
        raise ValueError(f"format must be parquet or csv, not {format!r}")
    out = df.sortWithinPartitions(sort) if sort else df
    if format == "parquet":
        out.write.mode("overwrite").option("compression", "snappy").parquet(output)
        return df.sparkSession.read.schema(df.schema).parquet(output)
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    flat = out.withColumns({name: F.to_json(name) for name in arrays})
    flat.write.mode("overwrite").option("header", "true").option("escape", '"').csv(output)
    reader = df.sparkSession.read.schema(flat.schema).option("header", "true").option("escape", '"')
    return reader.option("multiLine", "true").csv(output)
