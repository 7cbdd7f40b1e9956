"""Time-range and bounding-box selections, and the grid-cell table behind them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

CELL_DEGREES = 1.0
CELLS = ["lat_cell", "lon_cell"]


def _date_prune(lake: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Bounds on the record date, and on the path column where the table has one."""
    for name in ("date_partition", "date"):
        if name in lake.columns:
            if start:
                lake = lake.filter(F.col(name) >= start)
            if end:
                lake = lake.filter(F.col(name) <= end)
    return lake


def time_range(
    lake: DataFrame, start: str, end: str, source_type: str | None = None, hazard_type: str | None = None
) -> DataFrame:
    """Records with start <= date <= end, in order of collection."""
    out = _date_prune(lake, start, end)
    if source_type:
        out = out.filter(F.col("source_type") == source_type)
        if "source" in out.columns:
            out = out.filter(F.col("source") == source_type)
    if hazard_type:
        out = out.filter(F.col("hazard_type") == hazard_type)
    return out.orderBy("collected_at", "lake_id")


def bbox(lake: DataFrame, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> DataFrame:
    """Records on or inside the box; rows without a position never match.

    Plain comparisons on doubles reach the Parquet footer statistics. Where the
    table carries grid cells, a cell range prunes whole row groups first; a bound may be infinite.
    """
    out = lake
    if "lat_cell" in lake.columns:
        # Rows stored before there were cells have none; their points decide.
        for cell, least, most in (("lat_cell", min_lat, max_lat), ("lon_cell", min_lon, max_lon)):
            if math.isfinite(least):
                out = out.filter((F.col(cell) >= math.floor(least / CELL_DEGREES)) | F.col(cell).isNull())
            if math.isfinite(most):
                out = out.filter((F.col(cell) <= math.floor(most / CELL_DEGREES)) | F.col(cell).isNull())
    return out.filter(F.col("lat").between(min_lat, max_lat) & F.col("lon").between(min_lon, max_lon))


def cell_of(degrees: Column) -> Column:
    """Number of the grid row or column a coordinate lies in."""
    return F.floor(degrees / CELL_DEGREES).cast("int")


def grid_cells(lake: DataFrame) -> DataFrame:
    """One row per record with a position: id, point, and the cell it lies in."""
    return lake.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "lake_id", "lat", "lon", cell_of(F.col("lat")).alias("lat_cell"), cell_of(F.col("lon")).alias("lon_cell")
    )


def missing_cells(lake: DataFrame, cells: DataFrame) -> DataFrame:
    """Grid rows of positioned records that the cell table does not hold yet."""
    return grid_cells(lake).join(cells.select("lake_id"), "lake_id", "left_anti")


def labelled_text(
    lake: DataFrame, hazard_types: list[str] | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Records with text and a hazard, optionally of some classes and dates."""
    out = lake.filter(F.col("text").isNotNull() & F.col("hazard_type").isNotNull())
    if hazard_types:
        out = out.filter(F.col("hazard_type").isin(hazard_types))
    return _date_prune(out, start, end)
