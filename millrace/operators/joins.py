"""Removing, keeping and enriching rows by a second table.

All are plain equi-joins in one lazy plan: Spark chooses between broadcast and
shuffle from the sizes it sees and splits frequent keys.  Long texts are never
keys; their digests are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ColumnLike, as_column, blank_to_empty, canonicalize, trim_ws


def digest(text: ColumnLike) -> Column:
    """A 128-bit key of a text (binary md5); null for null."""
    return F.unhex(F.md5(as_column(text)))


def drop_known_questions(
    df: DataFrame, known: DataFrame, question: str, known_question: str,
) -> DataFrame:
    """Drop rows whose canonical question also occurs in ``known``.

    Only digests of the known questions are shuffled; rows with a null question stay.
    """
    keys = known.select(digest(canonicalize(known_question)).alias("__known")).distinct()
    keyed = df.withColumn("__key", digest(canonicalize(question)))
    return keyed.join(keys, F.col("__key") == F.col("__known"), "left_anti").drop("__key")


def drop_mismatches(
    df: DataFrame, verdicts: DataFrame, row_id: str, verdict_id: str = "question_id",
    verdict: str = "verdict", match: str = "prefix",
) -> DataFrame:
    """Drop rows a reviewer flagged as MISMATCH.

    ``prefix`` accepts an explanation after the word; ``exact`` is the literal
    comparison with the bare word.
    """
    text = trim_ws(F.col(verdict))
    flagged = text == "MISMATCH" if match == "exact" else F.startswith(text, F.lit("MISMATCH"))
    return drop_rows(df, verdicts.where(flagged), row_id, verdict_id)


def drop_rows(df: DataFrame, listed: DataFrame, row_id: str, listed_id: str | None = None) -> DataFrame:
    """Drop rows whose id is listed (also: resume after the ids already written)."""
    ids = listed.select(F.col(listed_id or row_id).alias(row_id))
    return df.join(ids, row_id, "left_anti")


def attach_text(
    df: DataFrame, texts: DataFrame, row_id: str, text_id: str, text: str, name: str = "rationale"
) -> DataFrame:
    """Attach a generated text per row; rows without one get an empty text.

    ``texts`` holds at most one text per id.
    """
    found = texts.select(F.col(text_id).alias(row_id), F.col(text).alias(name))
    return df.join(found, row_id, "left").withColumn(name, blank_to_empty(name))


def keep_members(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Keep rows whose value occurs in ``allowed`` (each value may occur there often)."""
    return df.join(allowed.select(key).distinct(), key, "left_semi")


def is_changed(before: ColumnLike, after: ColumnLike) -> Column:
    return trim_ws(as_column(before)) != trim_ws(as_column(after))
