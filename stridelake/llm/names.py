"""Column names that do not clash with those of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, wanted: str) -> str:
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
