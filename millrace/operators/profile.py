"""Counts, shares and compositions; every result is a small table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import ColumnLike
from .joins import is_changed


def before_after_counts(df: DataFrame, keep: Column, by: Sequence[str] = ("split",)) -> DataFrame:
    """Rows per group before and after a filter, in one pass."""
    return df.groupBy(*by).agg(
        F.count("*").alias("rows_before"), F.count_if(keep).alias("rows_after")
    )


def answer_shares(
    df: DataFrame, by: Sequence[str] = ("split",), answer: str = "answer",
    letters: Sequence[str] | None = ("A", "B", "C", "D"),
) -> DataFrame:
    """Rows and percent per answer letter; shares are over all rows of the group.

    With ``letters`` each of them is listed even without rows; None lists the
    letters that occur.
    """
    if letters is None:
        counts = df.groupBy(*by, answer).agg(F.count("*").alias("rows"))
        total = F.sum("rows").over(Window.partitionBy(*by))
        return counts.withColumn("percent", 100.0 * F.col("rows") / total)
    per_group = df.groupBy(*by).agg(
        F.count("*").alias("__total"),
        *[F.count_if(F.col(answer) == x).alias(f"__{x}") for x in letters],
    )
    listed = F.explode(
        F.array(*[F.struct(F.lit(x).alias("answer"), F.col(f"__{x}").alias("rows")) for x in letters])
    )
    return per_group.withColumn("__s", listed).select(
        *by, F.col("__s.answer").alias(answer), F.col("__s.rows").alias("rows"),
        (100.0 * F.col("__s.rows") / F.col("__total")).alias("percent"),
    )


def distinct_values(df: DataFrame, value: Column, name: str = "values") -> DataFrame:
    return df.agg(F.count_distinct(value).alias(name))


def changed_counts(
    df: DataFrame, before: ColumnLike, after: ColumnLike, by: Sequence[str] = ("split",)
) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"), F.count_if(is_changed(before, after)).alias("rows_changed")
    )


def violations(df: DataFrame, rule: Column, row_id: str, by: Sequence[str] = ("split",)) -> DataFrame:
    """The ids of violating rows, one per row; the list is a table and may be large."""
    return df.where(rule).select(*by, row_id)


def violation_counts(df: DataFrame, rule: Column, by: Sequence[str] = ("split",)) -> DataFrame:
    return df.where(rule).groupBy(*by).agg(F.count("*").alias("violations"))


CARD_LINES = 1000  # sources, and splits, that a card lists


def composition(df: DataFrame, source: str = "dataset", split: str = "split") -> DataFrame:
    """Rows and percent of the whole per source and split, with all totals.

    Totals carry ``(all)`` in place of the source or split.
    """
    counts = df.groupBy(source, split).agg(F.count("*").alias("rows"))
    levels = counts.cube(source, split).agg(
        F.sum("rows").alias("rows"), F.grouping_id().alias("__level")
    )
    whole = counts.agg(F.sum("rows").alias("rows")).scalar()
    return levels.select(
        F.when(F.col("__level") >= 2, "(all)").otherwise(F.col(source)).alias(source),
        F.when(F.col("__level") % 2 == 1, "(all)").otherwise(F.col(split)).alias(split),
        "rows",
        (100.0 * F.col("rows") / whole).alias("percent"),
    )


def card_lines(df: DataFrame, source: str = "dataset", split: str = "split") -> DataFrame:
    """The lines of a card as rows (section, name, rows, percent, line), however many sources and splits there are.

    ``section`` is ``whole``, ``source``, ``split`` or, for one source in one split, ``part``.
    """
    shares = composition(df, source, split)
    all_sources, all_splits = F.col(source) == "(all)", F.col(split) == "(all)"
    section = F.when(all_sources & all_splits, "whole").when(all_splits, "source").when(all_sources, "split").otherwise("part")
    name = F.when(all_sources & all_splits, "(all)").when(all_splits, F.col(source)).when(all_sources, F.col(split)).otherwise(F.concat_ws(" / ", source, split))
    line = F.format_string("- **%s**: %,d samples (%.1f%%)", F.col("name"), F.col("rows"), F.col("percent"))
    return shares.select(section.alias("section"), name.alias("name"), "rows", "percent").withColumn("line", line)


def dataset_card(df: DataFrame, title: str, source: str = "dataset", split: str = "split", most: int = CARD_LINES) -> DataFrame:
    """A Markdown card with the composition, as a one-row table ``card``.

    One line per source and per split, by name; the ``most`` largest of each if there are more,
    followed by how many are left out (``card_lines`` has them all as rows).
    """
    lines = card_lines(df, source, split).where("section <> 'part'")
    largest = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("rows"), "name"))
    lines = lines.withColumn("__place", largest).groupBy("section").agg(
        F.count("*").alias("__lines"), F.max("rows").alias("rows"),
        F.array_sort(F.collect_list(F.when(F.col("__place") <= most, F.struct("name", "line")))).alias("__listed"))

    def section(name: str) -> Column:
        own = F.col("section") == name
        text = F.array_join(F.transform("__listed", lambda s: s["line"]), "\n")
        more = F.when(F.col("__lines") > most, F.format_string("\n- and %,d more", F.col("__lines") - most)).otherwise("")
        return F.coalesce(F.max(F.when(own, F.concat(text, more))), F.lit(""))

    return lines.agg(
        F.concat(
            F.lit(f"# {title}\n\nThis dataset contains "),
            F.format_string("%,d", F.max(F.when(F.col("section") == "whole", F.col("rows")))),
            F.lit(" samples.\n\n## Dataset Composition\n\n"), section("source"),
            F.lit("\n\n## Dataset Splits\n\n"), section("split"), F.lit("\n"),
        ).alias("card")
    )
