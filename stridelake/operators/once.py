"""Expressions that should run once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns that later steps use many times.

    The optimizer copies a projected expression into every filter and column that uses it, so a
    parsed document would be parsed again for each of its fields. A generator runs once per row.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline(F.array(made)))
