"""Schemas of landed lines, the three bronze tables and the silver record."""

from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
_SA = T.ArrayType(T.StringType())


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


LOCATION = _schema(("name", _S), ("lat", _D), ("lon", _D))

# One struct that can hold any landed line; payloads stay JSON text.
BRONZE_LINE = _schema(
    ("source_type", _S), ("source_name", _S), ("record_id", _S), ("collected_at", _S),
    ("published_at", _S), ("url", _S), ("text", _S), ("language", _S),
    ("keywords_hit", _SA), ("location", LOCATION), ("media_urls", _SA), ("raw_payload", _S),
    ("location_name", _S), ("lat", _D), ("lon", _D), ("temperature_c", _D),
    ("humidity_pct", _D), ("wind_speed_ms", _D), ("wind_dir_deg", _D), ("rainfall_mm", _D),
    ("pressure_hpa", _D), ("condition", _S),
    ("source_url", _S), ("local_path", _S), ("media_type", _S), ("source_record_id", _S),
    ("file_size_kb", _D), ("width", _I), ("height", _I),
)

RAW_RECORDS = _schema(
    ("source_type", _S), ("source_name", _S), ("record_id", _S), ("collected_at", _S),
    ("published_at", _S), ("date_partition", _S), ("url", _S), ("text", _S), ("language", _S),
    ("keywords_hit", _SA), ("media_urls", _SA), ("location", LOCATION), ("raw_payload", _S),
)

WEATHER_RECORDS = _schema(
    ("location_name", _S), ("lat", _D), ("lon", _D), ("collected_at", _S),
    ("date_partition", _S), ("temperature_c", _D), ("humidity_pct", _D), ("wind_speed_ms", _D),
    ("wind_dir_deg", _D), ("rainfall_mm", _D), ("pressure_hpa", _D), ("condition", _S),
    ("raw_payload", _S),
)

MEDIA_RECORDS = _schema(
    ("source_url", _S), ("local_path", _S), ("media_type", _S), ("collected_at", _S),
    ("date_partition", _S), ("source_record_id", _S), ("file_size_kb", _D), ("width", _I),
    ("height", _I),
)

LAKE = _schema(
    ("lake_id", _S), ("source_type", _S), ("source_name", _S), ("record_id", _S),
    ("collected_at", _S), ("published_at", _S), ("date_partition", _S), ("url", _S),
    ("text", _S), ("language", _S), ("keywords_hit", _SA), ("hazard_type", _S),
    ("hazard_severity", _S), ("location_name", _S), ("lat", _D), ("lon", _D),
    ("media_urls", _SA), ("engagement_score", _D), ("temperature_c", _D),
    ("humidity_pct", _D), ("wind_speed_ms", _D), ("rainfall_mm", _D), ("pressure_hpa", _D),
    ("weather_condition", _S), ("media_type", _S), ("local_path", _S), ("file_size_kb", _D),
)
LAKE_COLUMNS = LAKE.fieldNames()

# The silver Parquet adds its two path columns.
LAKE_ON_DISK = T.StructType(
    LAKE.fields + [T.StructField("date", _S), T.StructField("source", _S)]
)

# The text index of the store: postings, and the size of every insert that is indexed.
# A record is named by its insert and its number there (``doc``), which its row in the store bears too.
POSTINGS = _schema(
    ("token", _S), ("doc", T.LongType()), ("places", T.ArrayType(T.LongType())), ("len", _I), ("bucket", _I), ("insert", _S),
)
CORPUS = _schema(("docs", T.LongType()), ("tokens", T.LongType()), ("insert", _S))
DERIVED = {"postings": POSTINGS, "corpus": CORPUS}

# Keys under which the first arrival wins.
KEYS = {
    "raw_records": ["source_type", "record_id"],
    "weather_records": ["location_name", "collected_at"],
    "media_records": ["source_url"],
    "lake_records": ["source_type", "record_id"],
}
TABLES = {
    "raw_records": RAW_RECORDS,
    "weather_records": WEATHER_RECORDS,
    "media_records": MEDIA_RECORDS,
    "lake_records": LAKE,
}
