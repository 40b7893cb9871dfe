"""Computed columns that stay computed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters do not recompute.

    A filter on a computed column is normally moved below the computation, which
    repeats it; a generator of exactly one row is where that stops.
    """
    bundle = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(bundle)))
