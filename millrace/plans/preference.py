"""The preference corpus: two sources sampled, filtered, split and joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.keys import hash_key
from ..functions.rules import is_usable_preference
from ..functions.tokens import TokenCounter, count_tokens
from ..operators.columns import computed_once
from ..operators.order import sample_rows
from ..operators.shape import from_code_preferences, from_math_preferences, union_sources
from ..operators.splits import three_way_split
from ..session import staged

COLUMNS = ("prompt", "chosen", "rejected", "dataset", "id")


def usable_pairs(
    df: DataFrame, counter: TokenCounter = count_tokens,
    max_prompt: int = V.PREFERENCE_PROMPT_TOKENS, max_total: int = V.PREFERENCE_TOTAL_TOKENS,
) -> DataFrame:
    return df.where(is_usable_preference("prompt", "chosen", "rejected", counter, max_prompt, max_total))


def preference_corpus(
    math: DataFrame, code: DataFrame, row_id: str = "row_id", math_rows: int | None = None,
    code_rows: int | None = None, test_share: float = 0.1, validation_share: float = 0.1,
    counter: TokenCounter = count_tokens, seed: int = V.SEED,
) -> DataFrame:
    """``prompt, chosen, rejected, dataset, id, split, shuffle_key``; split sizes exact per source.

    All rows take part unless ``math_rows`` or ``code_rows`` asks for a sample.
    """
    math = math if math_rows is None else sample_rows(math, row_id, math_rows, seed)
    code = code if code_rows is None else sample_rows(code, row_id, code_rows, seed)
    math_pairs, code_pairs = from_math_preferences(math, row_id), from_code_preferences(code, row_id)
    both = union_sources([math_pairs.select(*COLUMNS), code_pairs.select(*COLUMNS)])
    usable = staged(usable_pairs(computed_once(both, prompt=F.col("prompt")), counter), "preferences")
    split = three_way_split(usable, "id", test_share, validation_share, seed, group=["dataset"])
    return split.withColumn("shuffle_key", hash_key(seed, "dataset", "id"))
