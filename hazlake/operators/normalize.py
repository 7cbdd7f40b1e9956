"""Landed records to the 27-column silver record, and to the three bronze tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hazlake import taxonomy as tx
from hazlake.functions.classify import corpus, hazard_of, severity_of
from hazlake.functions.once import once
from hazlake.functions.payload import engagement_score
from hazlake.schemas import BRONZE_LINE, LAKE, LOCATION, MEDIA_RECORDS, RAW_RECORDS, WEATHER_RECORDS


SHAPES = ["weather", "media", "text"]


def _text(col: Column, default: str = "") -> Column:
    """The value, or the default for null and empty."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def _array(col: Column) -> Column:
    return F.coalesce(col, F.array().cast("array<string>"))


def lake_id(source_type: Column, record_id: Column) -> Column:
    """Same record, same id: SHA-256 over source and record id."""
    return F.sha2(F.concat_ws("\x1f", source_type, record_id), 256)


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *[c for c in df.columns if c == "_row"])


def _finish(df: DataFrame, carried: list[str]) -> DataFrame:
    have = set(df.columns)
    computed = {"lake_id": lake_id(F.col("source_type"), F.col("record_id"))}
    return df.select(
        *carried,
        *[
            computed.get(f.name, F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LAKE.fields
        ],
    )


def _is_record() -> Column:
    return F.col("shape").isin(*SHAPES) & (F.length(F.col("rec.collected_at")) > 0)


def normalize(parsed: DataFrame, taxonomy: tx.Taxonomy = tx.DEFAULT) -> DataFrame:
    """Parsed lines (``shape``, ``rec``) of any shape to silver records, in one pass.

    Every field is one ``when`` over the record's shape, so the input is scanned
    and classified once. Unknown shapes and records without a date are dropped.
    """
    return _normalized(parsed.filter(_is_record()), taxonomy, [])


def with_records(parsed: DataFrame, taxonomy: tx.Taxonomy = tx.DEFAULT) -> DataFrame:
    """Parsed lines with their silver record in ``lake``, null where ``normalize`` drops the line; ``records`` reads it.

    All lines stay. The text, which is the line's own, is not held twice; ``lake`` holds the record's marks instead.
    """
    named = _normalized(parsed.select("shape", "rec"), taxonomy, ["shape", "rec"])
    marked = named.withColumns(marks())
    kept = [name for name in (*LAKE.fieldNames(), *marks()) if name != "text"]
    return marked.select("shape", "rec", F.when(_is_record(), F.struct(*kept)).alias("lake"))


def records(staged: DataFrame) -> DataFrame:
    """Silver records out of ``with_records``, with their marks and the line's number."""
    text = F.when(F.col("shape") == "text", F.col("rec.text")).alias("text")
    fields = [text if name == "text" else F.col(f"lake.{name}") for name in (*LAKE.fieldNames(), *marks())]
    return staged.filter(_is_record()).select(*fields, *[c for c in staged.columns if c == "_row"])


def marks() -> dict[str, Column]:
    """Two hashes of a silver record: rows with the same pair are taken as equal.

    The first settles which of equal arrivals is the first. As it passes over nulls and the bounds
    of arrays, the second also goes over which fields are null, and over arrays as JSON.
    """
    arrays = [f.name for f in LAKE.fields if f.dataType.typeName() == "array"]
    nulls = reduce(lambda a, b: a + b, [F.isnull(f.name).cast("int") * F.lit(1 << i) for i, f in enumerate(LAKE.fields)])
    plain = [F.to_json(c) if c in arrays else F.col(c) for c in LAKE.fieldNames()]
    return {"_hash": F.xxhash64(*LAKE.fieldNames()), "_mark": F.xxhash64(nulls, *plain)}


def _normalized(shaped: DataFrame, taxonomy: tx.Taxonomy, carried: list[str]) -> DataFrame:
    # Plain columns from here on: struct fields do not survive pruning through a generator.
    flat = shaped.select(
        *dict.fromkeys(["shape", *carried]),
        *[F.col(f"rec.{f.name}").alias(f"in_{f.name}") for f in BRONZE_LINE.fields if f.name != "location"],
        *[F.col(f"rec.location.{name}").alias(f"in_place_{name}") for name in LOCATION.fieldNames()],
    )
    r = F.col
    weather, media = r("shape") == "weather", r("shape") == "media"
    rain = F.coalesce(r("in_rainfall_mm"), F.lit(0.0))
    condition = _text(r("in_condition"))
    critical = (rain >= tx.RAIN_CRITICAL_MM) | condition.contains("CRITICAL")
    warning = (rain >= tx.RAIN_WARNING_MM) | condition.contains("WARNING")

    # What the class is read from: hit phrases plus the text, or plus the weather condition.
    keywords = (
        F.when(media, _array(F.lit(None).cast("array<string>")))
        .when(weather & critical, F.array(F.lit("critical rainfall")))
        .when(weather & warning, F.array(F.lit("heavy rainfall")))
        .when(weather, _array(F.lit(None).cast("array<string>")))
        .otherwise(_array(r("in_keywords_hit")))
    )
    body = F.when(weather, condition).otherwise(r("in_text"))
    step = once(flat, {"keywords_hit": keywords, "corpus": F.when(~media, corpus(keywords, body, taxonomy))})
    step = once(step, {"found": hazard_of(r("corpus"), taxonomy)})

    source_type = F.when(weather, "weather").when(media, "media").otherwise(F.lower(_text(r("in_source_type"))))
    url = F.when(media, _text(r("in_source_url"))).when(~weather, r("in_url"))
    place = F.when(weather, _text(r("in_location_name"))).when(~media, r("in_place_name"))
    record_id = (
        F.when(weather, F.concat(F.lit("weather_"), _text(r("in_location_name")), F.lit("_"), r("in_collected_at")))
        .when(media, F.coalesce(F.nullif(r("in_source_record_id"), F.lit("")), _text(r("in_source_url"))))
        .otherwise(_text(r("in_record_id")))
    )
    severity = (
        F.when(weather & critical, "CRITICAL")
        .when(weather & warning, "WARNING")
        .when(weather, "INFO")
        .when(r("found").isNotNull(), severity_of(r("corpus"), taxonomy))
    )

    def only(shape_test: Column, name: str) -> Column:
        return F.when(shape_test, r(f"in_{name}"))

    out = step.select(
        *carried,
        source_type.alias("source_type"),
        F.when(weather, "openweathermap").when(media, "media_collector")
        .otherwise(_text(r("in_source_name"))).alias("source_name"),
        record_id.alias("record_id"),
        r("in_collected_at").alias("collected_at"),
        F.when(~weather & ~media, r("in_published_at")).alias("published_at"),
        F.substring(r("in_collected_at"), 1, 10).alias("date_partition"),
        url.alias("url"),
        F.when(~weather & ~media, r("in_text")).alias("text"),
        F.when(weather | media, "en").otherwise(_text(r("in_language"), "en")).alias("language"),
        "keywords_hit",
        F.when(weather & r("found").isNull() & (rain >= tx.RAIN_WARNING_MM), "CLOUDBURST")
        .otherwise(r("found")).alias("hazard_type"),
        severity.alias("hazard_severity"),
        place.alias("location_name"),
        F.when(weather, r("in_lat")).when(~media, r("in_place_lat")).alias("lat"),
        F.when(weather, r("in_lon")).when(~media, r("in_place_lon")).alias("lon"),
        F.when(media, F.array_compact(F.array(F.nullif(r("in_source_url"), F.lit("")))))
        .when(weather, _array(F.lit(None).cast("array<string>")))
        .otherwise(_array(r("in_media_urls"))).alias("media_urls"),
        F.when(~weather & ~media, engagement_score(source_type, r("in_raw_payload"))).alias("engagement_score"),
        only(weather, "temperature_c").alias("temperature_c"),
        only(weather, "humidity_pct").alias("humidity_pct"),
        only(weather, "wind_speed_ms").alias("wind_speed_ms"),
        only(weather, "rainfall_mm").alias("rainfall_mm"),
        only(weather, "pressure_hpa").alias("pressure_hpa"),
        F.when(weather, condition).alias("weather_condition"),
        F.when(media, _text(r("in_media_type"))).alias("media_type"),
        only(media, "local_path").alias("local_path"),
        only(media, "file_size_kb").alias("file_size_kb"),
    )
    return _finish(out, carried)


def ingest_counts(parsed: DataFrame, by_table: bool = False) -> DataFrame:
    """One row: loaded, normalized, skipped, malformed, partitions; ``by_table`` adds the lines of each bronze table."""
    shape, good = F.col("shape"), F.col("shape").isNotNull()
    kept = good & shape.isin(*SHAPES) & (F.length(_text(F.col("rec.collected_at"))) > 0)
    source = F.when(shape == "text", F.lower(_text(F.col("rec.source_type")))).otherwise(shape)
    day = F.substring(F.col("rec.collected_at"), 1, 10)
    tables = [F.count_if(bronze_shape() == shape).alias(shape) for shape in SHAPES] if by_table else []
    return parsed.agg(
        *tables,
        F.count_if(good).alias("loaded"),
        F.count_if(kept).alias("normalized"),
        F.count_if(good & ~kept).alias("skipped"),
        F.count_if(~good).alias("malformed"),
        F.count_distinct(F.when(kept, F.struct(day, source))).alias("partitions"),
    )


def bronze_shape() -> Column:
    """The bronze table of a parsed line: anything that is neither weather nor media is text."""
    return F.when(F.col("shape") == "unknown", "text").otherwise(F.col("shape"))


def _flat(parsed: DataFrame, shape: str) -> DataFrame:
    chosen = parsed.filter(bronze_shape() == shape).select("rec.*", *[c for c in parsed.columns if c == "_row"])
    return chosen.withColumns(
        {
            "collected_at": _text(F.col("collected_at")),
            "date_partition": F.substring(_text(F.col("collected_at")), 1, 10),
        }
    )


def raw_records(parsed: DataFrame) -> DataFrame:
    out = _flat(parsed, "text").withColumns(
        {
            "source_type": F.lower(_text(F.col("source_type"))),
            "source_name": _text(F.col("source_name")),
            "record_id": _text(F.col("record_id")),
            "language": _text(F.col("language"), "en"),
            "keywords_hit": _array(F.col("keywords_hit")),
            "media_urls": _array(F.col("media_urls")),
            "raw_payload": F.coalesce(F.col("raw_payload"), F.lit("{}")),
        }
    )
    return _typed(out, RAW_RECORDS)


def weather_records(parsed: DataFrame) -> DataFrame:
    out = _flat(parsed, "weather").withColumns(
        {
            "location_name": _text(F.col("location_name")),
            "raw_payload": F.coalesce(F.col("raw_payload"), F.lit("{}")),
        }
    )
    return _typed(out, WEATHER_RECORDS)


def media_records(parsed: DataFrame) -> DataFrame:
    out = _flat(parsed, "media").withColumns(
        {name: _text(F.col(name)) for name in ("source_url", "local_path", "media_type")}
    )
    return _typed(out, MEDIA_RECORDS)
