"""Joining a per-group summary back to the rows it summarises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on null-safe equality of ``on``; the key columns of ``df`` stay.

    The summary is part of the same lazy plan.  Spark sees its size when the
    query runs, and broadcasts it or shuffles both sides accordingly.
    """
    renamed = summary.select(
        *[F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in summary.columns]
    )
    condition = F.lit(True)
    for column in on:
        condition = condition & F.col(column).eqNullSafe(F.col(f"__{column}"))
    return df.join(renamed, condition, how).drop(*[f"__{c}" for c in on])


def refuse_columns(df: DataFrame, *names: str) -> None:
    """Raise where the input already has a column that the result would overwrite."""
    taken = sorted(set(names) & set(df.columns))
    if taken:
        raise ValueError(f"columns exist already: {taken}")
