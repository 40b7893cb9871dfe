"""Hash keys: reproducible randomness that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .text import ColumnLike, as_column, normalize_spaces


def hash_key(seed: int | str, *parts: ColumnLike) -> Column:
    """Hex md5 of seed and parts joined by ``:``.  Sorting by it is a seeded shuffle."""
    texts = [as_column(p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def hash_number(key: Column) -> Column:
    """60 bits of a hash key as a non-negative BIGINT."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")


def below_fraction(key: Column, fraction: float) -> Column:
    """True for about ``fraction`` of all keys, as a plain string comparison."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(key, 1, 8) < format(int(fraction * 2**32), "08x")


def content_hash(question: ColumnLike, choices: ColumnLike | None = None, ordered: bool = False) -> Column:
    """md5 over the space-normalised question and choices.

    Choices are sorted first, so a shuffled copy counts as a copy; ``ordered``
    keeps their order.  A null question has a null hash; null choices count.
    """
    parts = F.array(normalize_spaces(question))
    if choices is not None:
        options = F.transform(as_column(choices), normalize_spaces)
        parts = F.concat(parts, options if ordered else F.array_sort(options))
    joined = F.array_join(parts, V.FIELD_MARK, V.FIELD_MARK + "null")
    return F.when(as_column(question).isNotNull(), F.md5(joined))
