"""Compute a costly column once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    Filters are pushed below projections by copying the projected expressions
    into them, so a filter on a parsed or cleaned column would parse or clean
    every row twice (or more, if the column is used several times). Going
    through a one-row generator keeps such a filter above the computation.
    """
    replaced = [c for c in df.columns if c not in columns]
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*replaced, F.inline(F.array(row)))
