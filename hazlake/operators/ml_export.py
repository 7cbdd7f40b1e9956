"""The labelled text dataset: clean text, confidence, scaled engagement, temporal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazlake.functions.once import once
from hazlake.functions.text import clean_text, label_confidence
from hazlake.operators.ranges import labelled_text

# The exported columns; label_confidence and split follow.
COLUMNS = [
    "lake_id", "source_type", "date_partition", "text", "keywords_hit", "hazard_type",
    "hazard_severity", "location_name", "lat", "lon", "engagement_score", "language",
    "temperature_c", "humidity_pct", "wind_speed_ms", "rainfall_mm", "pressure_hpa",
]


def scale_engagement(df: DataFrame) -> DataFrame:
    """Engagement over the largest of its source; as it is where that is null or <= 0.

    The maxima come from a map-side aggregate and are joined back. A window per
    source would pull a dominant source into one task. No join hint: AQE
    broadcasts the maxima by their measured size, or splits the skewed side.
    """
    peaks = df.groupBy(F.col("source_type").alias("_source")).agg(F.max("engagement_score").alias("_peak"))
    joined = df.join(peaks, F.col("source_type").eqNullSafe(F.col("_source")), "left").drop("_source")
    scaled = F.when(F.col("_peak") > 0, F.col("engagement_score") / F.col("_peak")).otherwise(
        F.col("engagement_score")
    )
    return joined.withColumn("engagement_score", scaled).drop("_peak")


def split_cutoffs(df: DataFrame, train: float = 0.8, val: float = 0.1, date: str = "date_partition") -> DataFrame:
    """One row: last train date and last validation date.

    Only distinct calendar days meet in one row, never records.
    """
    days = df.select(date).distinct().agg(F.array_sort(F.collect_list(date)).alias("days"))

    def nth(share: float) -> Column:
        position = F.greatest(F.lit(1), F.floor(F.size("days") * F.lit(share)).cast("int"))
        return F.try_element_at("days", position)

    return days.select(nth(train).alias("train_end"), nth(train + val).alias("val_end"))


def temporal_split(
    df: DataFrame, train: float = 0.8, val: float = 0.1, date: str = "date_partition"
) -> DataFrame:
    """Add ``split``: every train day lies before every val day, and those before every test day."""
    cut = split_cutoffs(df, train, val, date).select(F.struct("train_end", "val_end").alias("cut")).scalar()
    label = (
        F.when(F.col(date) <= F.col("_cut.train_end"), "train")
        .when(F.col(date) <= F.col("_cut.val_end"), "val")
        .otherwise("test")
    )
    return df.withColumn("_cut", cut).withColumn("split", label).drop("_cut")


def cleaned(
    lake: DataFrame,
    hazard_types: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    keep_unicode: bool = False,
) -> DataFrame:
    """Labelled records with clean text and confidence; texts that clean to nothing are dropped."""
    chosen = labelled_text(lake, hazard_types, start, end).select(*COLUMNS, "collected_at")
    return (
        once(chosen, {"text": clean_text(F.col("text"), keep_unicode)})
        .filter(F.col("text").isNotNull())
        .withColumn("label_confidence", label_confidence(F.col("text"), F.col("keywords_hit")))
    )


def finish(clean: DataFrame, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Cleaned records to the 19 export columns."""
    return scale_engagement(temporal_split(clean, train, val)).select(*COLUMNS, "label_confidence", "split")


def ml_dataset(lake: DataFrame, train: float = 0.8, val: float = 0.1, **filters) -> DataFrame:
    return finish(cleaned(lake, **filters), train, val)
