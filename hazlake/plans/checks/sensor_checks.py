"""Rolling features and forward labels. Slices of six days make places cross many slice borders."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazlake.functions.times import calendar_parts, parse_iso
from hazlake.operators import sensor
from hazlake.plans.checks import base as b

_H = 3_600_000_000
_WINDOWS = f"""WINDOW
  so_far AS (PARTITION BY location_name ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  before AS (PARTITION BY location_name ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  h3 AS (PARTITION BY location_name ORDER BY us RANGE BETWEEN {3 * _H - 1} PRECEDING AND CURRENT ROW),
  h24 AS (PARTITION BY location_name ORDER BY us RANGE BETWEEN {24 * _H - 1} PRECEDING AND CURRENT ROW),
  h72 AS (PARTITION BY location_name ORDER BY us RANGE BETWEEN {72 * _H - 1} PRECEDING AND CURRENT ROW)"""

SQL_FEATURES = "WITH " + b.SQL_READINGS + "," + b.SQL_HAZARDS + f""", filled AS (
  SELECT *, last_value(temperature_c IGNORE NULLS) OVER so_far AS temp, last_value(pressure_hpa IGNORE NULLS) OVER so_far AS pres,
    last_value(pressure_hpa IGNORE NULLS) OVER before AS prev_pres, count(*) FILTER (rainfall_mm <= 0) OVER so_far AS island
  FROM readings {_WINDOWS}
), rolled AS (
  SELECT *, sum(rainfall_mm) OVER h3 AS rainfall_3h_sum, sum(rainfall_mm) OVER h24 AS rainfall_24h_sum,
    sum(rainfall_mm) OVER h72 AS rainfall_72h_sum, max(rainfall_mm) OVER h24 AS rainfall_24h_max,
    max(coalesce(wind_speed_ms, 0)) OVER h24 AS wind_24h_max, max(coalesce(humidity_pct, 0)) OVER h24 AS humidity_24h_max,
    temp - avg(temp) OVER h24 AS temp_change_24h, pres - avg(prev_pres) OVER h3 AS pressure_drop_3h,
    count(*) FILTER (rainfall_mm > 0) OVER (PARTITION BY location_name, island ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS consecutive_rain_readings,
    month(ts) AS month, hour(ts) AS hour, dayofyear(ts) AS day_of_year
  FROM filled {_WINDOWS}
), features AS (
  SELECT r.*, h.us - r.us AS gap, CASE WHEN h.us <= r.us + {24 * _H} THEN 1 ELSE 0 END AS hazard_within_24h,
    CASE WHEN h.us <= r.us + {24 * _H} THEN h.hazard_type END AS upcoming_hazard_type
  FROM rolled r ASOF LEFT JOIN hazards h ON r.location_name = h.location_name AND r.us < h.us
)"""


def _features(spark: SparkSession, folder: str, frames: bool) -> DataFrame:
    readings, hazards = b.event_readings(spark, folder), b.event_hazards(spark, folder)
    return sensor.sensor_features(readings, hazards, frames, slice_cells=2).withColumn("us", F.unix_micros("collected_at"))


def _check(name: str, columns: list[str], rounded: list[str] = (), whole: list[str] = ()):
    sql_cols = list(columns) + [f"{b.sql_r6(c)} AS {c}" for c in rounded] + [f"{c}::BIGINT AS {c}" for c in whole]
    wanted = {*columns, *rounded, *whole}

    @b.check(SQL_FEATURES + f" SELECT location_name, us, {', '.join(sql_cols)} FROM features", name)
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _features(spark, folder, not wanted.isdisjoint(sensor.FRAMES)).select(
            "location_name", "us", *columns, *[b.r6(F.col(c)).alias(c) for c in rounded],
            *[F.col(c).cast("bigint").alias(c) for c in whole],
        )

    return query


_check("rolling_rain", [], ["rainfall_3h_sum", "rainfall_24h_sum", "rainfall_72h_sum", "rainfall_24h_max"])
_check("rolling_wind_humidity", [], ["wind_24h_max", "humidity_24h_max"])
_check("temp_change", [], ["temp_change_24h"])
_check("pressure_drop", [], ["pressure_drop_3h"])
_check("rain_run", [], [], ["consecutive_rain_readings"])
_check("hazard_ahead", ["upcoming_hazard_type"], [], ["hazard_within_24h"])
_check(
    "sensor_features", ["date_partition", "upcoming_hazard_type"],
    ["lat", "lon", "temperature_c", "temp_change_24h", "humidity_pct", "humidity_24h_max", "wind_speed_ms", "wind_dir_deg",
     "wind_24h_max", "rainfall_mm", "rainfall_3h_sum", "rainfall_24h_sum", "rainfall_72h_sum", "rainfall_24h_max",
     "pressure_hpa", "pressure_drop_3h"],
    ["consecutive_rain_readings", "month", "hour", "day_of_year", "hazard_within_24h"],
)


@b.check(SQL_FEATURES + f" SELECT location_name, us, {b.sql_r6('temp')} AS temp, {b.sql_r6('pres')} AS pres FROM features")
def forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    rows = sensor.feature_rows(b.event_readings(spark, folder), slice_cells=2, frames=False)
    return rows.select("location_name", "us", b.r6(F.col("temp_filled")).alias("temp"), b.r6(F.col("pres_filled")).alias("pres"))


@b.check("SELECT event_id, month(ts)::BIGINT AS month, hour(ts)::BIGINT AS hour, dayofyear(ts)::BIGINT AS day_of_year FROM events")
def calendar(spark: SparkSession, folder: str) -> DataFrame:
    ts = parse_iso(b.iso_micros(F.col("ts")))
    parts = {k: v.cast("bigint") for k, v in calendar_parts(ts).items()}
    return b.load(spark, folder, "events").select("event_id", *[v.alias(k) for k, v in parts.items()])


@b.check("WITH " + b.SQL_READINGS + """
SELECT event_id, date_partition FROM readings WHERE date_partition BETWEEN '2024-01-08' AND '2024-01-20'""")
def sensor_date_filter(spark: SparkSession, folder: str) -> DataFrame:
    return sensor.readings_between(b.event_readings(spark, folder), "2024-01-08", "2024-01-20").select("event_id", "date_partition")


@b.check(b.sql_lake() + """
SELECT location_name, epoch_us(strptime(collected_at, '%Y-%m-%dT%H:%M:%S+00:00'))::BIGINT AS us, hazard_type FROM lake
WHERE hazard_type IS NOT NULL AND source_type <> 'weather' AND location_name IS NOT NULL""")
def event_filter(spark: SparkSession, folder: str) -> DataFrame:
    return sensor.hazard_events(b.doc_lake(spark, folder)).select(
        "location_name", F.unix_micros("ts").alias("us"), "hazard_type"
    )
