"""Keep-first deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import content_hash


def keep_first(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """Keep the row with the smallest id of every key; ids are unique in the table.

    A null key is equal to nothing: all its rows stay.

    Only (key, id) pairs are grouped, and partially before the shuffle, so a
    key shared by a large part of all rows costs one row per task.  The wide rows
    then meet the kept ids on the unique id.
    """
    keyed = df.select(key.alias("__key"), F.col(row_id))
    first = keyed.where("__key IS NOT NULL").groupBy("__key").agg(F.min(row_id).alias(row_id)).select(row_id)
    open_rows = keyed.where("__key IS NULL").select(row_id)
    return df.join(first.union(open_rows), row_id, "left_semi")


def drop_repeated_questions(
    df: DataFrame, row_id: str, question: str = "question", choices: str | None = "choices",
    ordered: bool = False, within: str | None = None,
) -> DataFrame:
    """Keep the first row of every normalised question with its choices.

    With ``within`` (such as the split) only rows of equal value are compared.
    """
    options = F.col(choices) if choices else None
    key = content_hash(question, options, ordered)
    return keep_first(df, F.concat(F.coalesce(F.col(within).cast("string"), F.lit("")), F.lit(":"), key) if within else key, row_id)
