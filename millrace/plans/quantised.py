"""Training sequences for the quantised model: plain prompts, padded, labels masked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.prompts import plain_completion, plain_prompt
from ..functions.text import ColumnLike
from ..functions.tokens import hashed_text
from ..operators.columns import computed_once
from ..operators.sequences import padded_sequences
from ..operators.splits import random_fraction


def quantised_sequences(
    df: DataFrame, row_id: str, encode: Callable[[ColumnLike], Column] | None = None, fraction: float = 1.0,
    limit: int = V.PADDED_TOKENS, fill: int = 0, seed: int = V.SEED,
) -> DataFrame:
    """All rows (or a random fraction of them) as ``input_ids, labels, attention_mask`` of equal length.

    ``encode`` turns a text into ids; by default the built-in tokens are hashed.
    ``dropped`` counts the tokens that the cut took away.
    """
    prompt = plain_prompt("question", "choices")
    full = F.concat(prompt, F.lit("\n"), plain_completion("choices", "answer", "rationale"))
    rows = random_fraction(df, row_id, fraction, seed)
    if encode is None:  # only tokens that stay are hashed
        texts = rows.select(row_id, F.concat(prompt, F.lit("\n")).alias("__p"), full.alias("__f"))
        ids = computed_once(texts, __head=hashed_text("__p", 0), __full=hashed_text("__f", limit))
        ids = ids.withColumns({
            "__full_ids": F.col("__full.ids"),
            "__prompt_ids": F.array_repeat(F.lit(0), F.least(F.col("__head.size"), F.lit(limit))),  # only its size counts
        })
        found = padded_sequences(ids, "__prompt_ids", "__full_ids", limit, fill)
        return found.withColumn("dropped", F.greatest(F.lit(0), F.col("__full.size") - limit)).select(
            row_id, "input_ids", "labels", "attention_mask", "dropped")
    encoded = rows.select(row_id, encode(F.concat(prompt, F.lit("\n"))).alias("__prompt_ids"), encode(full).alias("__full_ids"))
    return padded_sequences(encoded, "__prompt_ids", "__full_ids", limit, fill).drop(
        "__prompt_ids", "__full_ids"
    )
