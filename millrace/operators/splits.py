"""Train / validation / test splits with exact sizes.

All of them compare a row's hash key with one or two cut keys per group, so the
rows themselves are never shuffled or sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.keys import below_fraction, hash_key
from .attach import attach
from .order import attach_cut_keys, hash_order


def holdout(
    df: DataFrame, id_column: str, rows: int = V.HOLDOUT_ROWS, seed: int | str = V.SEED,
    split: str = "split", source: str = "train", target: str = "validation", digits: int = 3,
) -> DataFrame:
    """Move exactly ``rows`` randomly chosen rows of one split to another."""
    order = hash_order(id_column, seed, digits)
    inside = df.where(F.col(split) == source)
    marked = attach_cut_keys(df, order, {"__cut": lambda total: F.lit(rows)}, within=inside)
    moved = (F.col(split) == source) & (order.key <= F.col("__cut"))
    return marked.withColumn(split, F.when(moved, target).otherwise(F.col(split))).drop("__cut")


def top_up_validation(
    df: DataFrame, id_column: str, share: float | None = V.AQUA_TOPUP_SHARE, rows: int | None = None,
    seed: int | str = V.SEED, split: str = "split", digits: int = 3,
) -> DataFrame:
    """Move a share (rounded down) or a fixed number of train rows to validation."""
    order = hash_order(id_column, seed, digits)
    inside = df.where(F.col(split) == "train")
    size = (lambda total: F.lit(rows)) if rows is not None else (lambda total: F.floor(total * F.lit(share)))
    marked = attach_cut_keys(df, order, {"__cut": size}, within=inside)
    moved = (F.col(split) == "train") & (order.key <= F.col("__cut"))
    return marked.withColumn(split, F.when(moved, "validation").otherwise(F.col(split))).drop("__cut")


def three_way_split(
    df: DataFrame, id_column: str, test_share: float = 0.1, validation_share: float = 0.1,
    seed: int | str = V.SEED, group: Sequence[str] = (), split: str = "split",
    digits: int = 3,
) -> DataFrame:
    """Per group: the first share is test, the next validation, the rest train."""
    order = hash_order(id_column, seed, digits)

    def test_rows(total):
        return F.floor(total * F.lit(test_share))

    def held_rows(total):
        return test_rows(total) + F.floor(total * F.lit(validation_share))

    marked = attach_cut_keys(df, order, {"__test": test_rows, "__held": held_rows}, group)
    return marked.withColumn(
        split,
        F.when(order.key <= F.col("__test"), "test")
        .when(order.key <= F.col("__held"), "validation")
        .otherwise("train"),
    ).drop("__test", "__held")


def random_fraction(df: DataFrame, id_column: str, fraction: float = 0.15, seed: int | str = V.SEED) -> DataFrame:
    """About ``fraction`` of the rows, decided row by row."""
    return df.where(below_fraction(hash_key(seed, id_column), fraction))


def drop_split(df: DataFrame, name: str = "test", split: str = "split") -> DataFrame:
    return df.where(F.col(split) != name)


def evaluation_split(df: DataFrame, dataset: str = "dataset", split: str = "split") -> DataFrame:
    """Each dataset's validation rows, or its test rows where it has no validation."""
    present = df.groupBy(dataset).agg(F.max(F.col(split) == "validation").alias("__has"))
    wanted = F.when(F.col("__has"), "validation").otherwise("test")
    return attach(df, present, [dataset]).where(F.col(split) == wanted).drop("__has")
