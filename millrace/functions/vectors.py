"""Similarity of two vector or set columns of the same row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, as_column


def _folded(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def dot(a: ColumnLike, b: ColumnLike) -> Column:
    return _folded(
        F.zip_with(as_column(a), as_column(b), lambda x, y: x.cast("double") * y.cast("double"))
    )


def squared_distance(a: ColumnLike, b: ColumnLike) -> Column:
    def squared(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return _folded(F.zip_with(as_column(a), as_column(b), squared))


def cosine(a: ColumnLike, b: ColumnLike) -> Column:
    """Zero where either vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def jaccard(a: ColumnLike, b: ColumnLike) -> Column:
    """Shared over all distinct elements; zero for two empty sets."""
    union = F.size(F.array_union(as_column(a), as_column(b)))
    shared = F.size(F.array_intersect(as_column(a), as_column(b)))
    return F.when(union > 0, shared / union).otherwise(0.0)
