"""Answer choices: letters, seeded shuffles, distractor sampling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .keys import hash_key
from .text import ColumnLike, as_column, trim_ws


def letter_of(position: Column) -> Column:
    """Zero-based position to letter; null for a negative position."""
    return F.when(position >= 0, F.char(F.lit(65) + position))


def position_of(letter: ColumnLike) -> Column:
    """One letter (any case, padded or not) to zero-based position; null for everything else."""
    text = F.upper(trim_ws(letter))
    return F.when(F.rlike(text, F.lit(r"\A[A-Z]\z")), F.ascii(text) - 65)


def position_or_minus_one(letter: ColumnLike) -> Column:
    """Position of a single upper-case letter; -1 for everything else."""
    text = as_column(letter)
    return F.when(F.rlike(text, F.lit(r"\A[A-Z]\z")), F.ascii(text) - 65).otherwise(-1)


def choice_at(choices: ColumnLike, position: Column) -> Column:
    """Choice at a zero-based position, -1 being the last; null out of range."""
    index = F.when(position < 0, position).otherwise(position + 1)
    return F.try_element_at(as_column(choices), index.cast("int"))


def index_in(choices: ColumnLike, value: ColumnLike) -> Column:
    """Zero-based index of the first equal choice; -1 where absent."""
    return (F.array_position(as_column(choices), as_column(value)) - 1).cast("int")


def without_position(choices: ColumnLike, position: Column) -> Column:
    return F.filter(as_column(choices), lambda _, i: i != position)


def strip_letter_prefixes(options: ColumnLike) -> Column:
    """Remove repeated leading ``(A)``, ``(A)*``, ``A)`` from every option."""
    return F.transform(
        as_column(options), lambda o: trim_ws(F.regexp_replace(o, V.LETTER_PREFIX, ""))
    )


def shuffled(choices: ColumnLike, seed: int | str, row_id: ColumnLike) -> Column:
    """Choices in the order of a per-choice hash of seed, row and position."""
    keyed = F.transform(
        as_column(choices),
        lambda c, i: F.struct(hash_key(seed, row_id, i).alias("key"), c.alias("choice")),
    )
    return F.transform(F.array_sort(keyed), lambda s: s["choice"])


def sampled_choices(
    choices: ColumnLike, position: Column, seed: int | str, row_id: ColumnLike, distractors: int = 3
) -> Column:
    """The choice at ``position`` with a sample of the others, shuffled."""
    picked = F.slice(shuffled(without_position(choices, position), seed, row_id), 1, distractors)
    kept = F.concat(F.array(choice_at(choices, position)), picked)
    return shuffled(kept, f"{seed}-order", row_id)
