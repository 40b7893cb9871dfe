"""Filters that need more than one row, or produce two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as V
from ..functions.rules import within_tokens
from ..functions.tokens import TokenCounter, count_tokens
from ..session import staged
from .attach import attach
from .columns import computed_once


def partition_by_rule(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``; rows for which the rule is null are rejected."""
    passes = F.coalesce(rule, F.lit(False))
    return df.where(passes), df.where(~passes)


def flag_rows(df: DataFrame, rule: Column, name: str = "was_filtered") -> DataFrame:
    """Mark the rows that fail a rule."""
    return df.withColumn(name, ~F.coalesce(rule, F.lit(False)))


def exact_quantile(df: DataFrame, value: Column, share: float, group: Sequence[str], accuracy: int = 1000) -> DataFrame:
    """The interpolated quantile of whole numbers per group, as ``__cut``, with bounded state.

    A sketch, which tasks merge, brackets the two values around the wanted place;
    its rank error is at most the size of the group by ``accuracy``.  A second
    pass counts what lies below the bracket and how often each value in it occurs:
    a small part of the rows, read out exactly.  Nulls do not count.  The brackets are
    written first: Spark then knows how small they are, and no group is gathered in one task.
    """
    by = list(group)
    rows = df.select(*by, value.cast("bigint").alias("__v")).where(F.col("__v").isNotNull())
    reach = 2.0 / accuracy
    sketch = rows.groupBy(*by).agg(
        F.percentile_approx("__v", [max(0.0, share - reach), min(1.0, share + reach)], accuracy).alias("__b"),
        F.count("*").alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    # few rows may be beside the sketch's places, so the bracket of a small group is the whole group
    small = F.col("__n") <= 10 * accuracy
    bracket = sketch.select(
        *by, "__n", F.when(small, F.col("__min")).otherwise(F.col("__b")[0]).alias("__low"), F.when(small, F.col("__max")).otherwise(F.col("__b")[1]).alias("__high"))
    near = attach(rows, staged(bracket, "quantile-brackets"), by, how="inner")
    below, inside = F.col("__v") < F.col("__low"), F.col("__v") <= F.col("__high")
    # one row for all values below, one for each value of the bracket
    counts = near.where(inside).groupBy(*by, "__n", F.when(below, F.col("__low") - 1).otherwise(F.col("__v")).alias("__at")).agg(F.count("*").alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy(*by).orderBy("__at"))
    place = F.lit(share) * (F.col("__n") - 1)  # from 0
    ranked = counts.withColumn("__upto", upto)
    lower = F.min(F.when(F.col("__upto") > F.floor(place), F.col("__at")))
    upper = F.min(F.when(F.col("__upto") > F.ceil(place), F.col("__at")))
    found = ranked.groupBy(*by).agg(lower.alias("__lower"), upper.alias("__upper"), F.first(place - F.floor(place)).alias("__part"))
    cut = F.when(F.col("__part") == 0, F.col("__lower").cast("double")).otherwise(
        (1 - F.col("__part")) * F.col("__lower") + F.col("__part") * F.coalesce("__upper", "__lower"))
    return found.select(*by, cut.alias("__cut"))


def drop_shortest(
    df: DataFrame, text: str, share: float = 0.1, group: Sequence[str] = ("split",)
) -> DataFrame:
    """Keep texts longer than the exact ``share`` quantile of lengths in their group.

    Empty texts do not count towards the quantile, which takes bounded state (``exact_quantile``).
    The cuts are written first, so that they are sent to the texts and no text is shuffled by its group.
    """
    size = F.length(text)
    cuts = staged(exact_quantile(df.where(size > 0), size, share, group), "quantile-cuts")
    return attach(df, cuts, list(group)).where(size > F.col("__cut")).drop("__cut")


def within_budget(
    df: DataFrame, text: str, limit: int = V.PASSAGE_TOKENS, counter: TokenCounter = count_tokens,
    name: str = "tokens",
) -> DataFrame:
    """Texts of at most ``limit`` tokens, with their count; each text is counted once."""
    counted = computed_once(df, **{name: counter(F.col(text))})
    return counted.where(within_tokens(F.col(name), limit))
