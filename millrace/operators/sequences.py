"""Token-id sequences: masking, truncation, padding, passages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import fixed_values as V
from ..functions.tokens import (
    TokenCounter, count_tokens, cut, hashed_ids, hashed_text, masked_labels, ones, padded, passages, split_tokens,
)
from .columns import computed_once
from .order import number_order


def masked_sequences(
    df: DataFrame, prompt_ids: str, completion_ids: str, limit: int = V.QUIZ_TOKENS,
    end_id: int | None = None,
) -> DataFrame:
    """Prompt and completion ids joined, the prompt masked in the labels, cut at ``limit``.

    ``end_id`` closes the completion before the cut.  ``dropped`` counts the tokens
    that the cut took away.
    """
    completion = F.col(completion_ids)
    if end_id is not None:
        completion = F.concat(completion, F.array(F.lit(end_id)))
    whole = F.concat(F.col(prompt_ids), completion)
    ids = cut(whole, limit)
    labels = cut(masked_labels(prompt_ids, completion), limit)
    dropped = F.greatest(F.lit(0), F.size(whole) - limit)
    return df.withColumns({"input_ids": ids, "labels": labels, "attention_mask": ones(ids), "dropped": dropped})


def masked_token_sequences(
    df: DataFrame, prompt: str, completion: str, encode: Callable[[Column], Column] | None = None,
    limit: int = V.QUIZ_TOKENS, end_id: int | None = None,
) -> DataFrame:
    """``masked_sequences`` of texts or of token lists: only the tokens that stay within ``limit`` are encoded.

    ``encode`` turns a list of tokens into as many ids.  Without it tokens are hashed; columns of texts are then
    split and hashed together (``hashed_text``).  ``dropped`` counts the tokens that the cut took away.
    """
    if encode is None and df.schema[prompt].dataType == df.schema[completion].dataType == T.StringType():
        once = computed_once(df, __p=hashed_text(prompt, limit), __c=hashed_text(completion, limit))
        once = once.withColumns({"__prompt": F.col("__p.ids"), "__completion": F.col("__c.ids")})
        sizes, extra = F.col("__p.size") + F.col("__c.size"), ["__p", "__c"]
    else:
        head = split_tokens(prompt) if df.schema[prompt].dataType == T.StringType() else F.col(prompt)
        tail = split_tokens(completion) if df.schema[completion].dataType == T.StringType() else F.col(completion)
        encode, room = encode or hashed_ids, F.greatest(F.lit(0), F.lit(limit) - F.size(head))
        once = computed_once(df, __prompt=encode(cut(head, limit)), __completion=encode(F.slice(tail, F.lit(1), room)),
                             __size=F.size(head) + F.size(tail))
        sizes, extra = F.col("__size"), ["__size"]
    found = masked_sequences(once, "__prompt", "__completion", limit, end_id)
    dropped = F.greatest(F.lit(0), sizes + int(end_id is not None) - limit)
    return found.withColumn("dropped", dropped).drop("__prompt", "__completion", *extra)


def padded_sequences(
    df: DataFrame, prompt_ids: str, full_ids: str, limit: int = V.PADDED_TOKENS, fill: int = 0
) -> DataFrame:
    """The full text's ids cut and padded to ``limit``; labels masked over the prompt only.

    Padding keeps its id in the labels; only the attention mask tells it apart.
    ``dropped`` counts the tokens that the cut took away.
    """
    dropped = F.greatest(F.lit(0), F.size(F.col(full_ids)) - limit)
    short = cut(full_ids, limit)
    ids = padded(short, F.lit(limit), fill)
    hidden = F.least(F.size(F.col(prompt_ids)), F.lit(limit))
    labels = F.concat(
        F.array_repeat(F.lit(V.MASK), hidden), F.slice(ids, hidden + 1, F.lit(limit))
    )
    return df.withColumns(
        {"input_ids": ids, "labels": labels, "attention_mask": padded(ones(short), F.lit(limit), 0), "dropped": dropped}
    )


def pad_batches(df: DataFrame, batch: str = "batch_id", fill: int = 0) -> DataFrame:
    """Pad ids, labels and attention mask to the longest sequence of the batch."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    wide = df.withColumn("__longest", longest)
    return wide.withColumns(
        {
            "input_ids": padded("input_ids", "__longest", fill),
            "labels": padded("labels", "__longest", V.MASK),
            "attention_mask": padded("attention_mask", "__longest", 0),
        }
    ).drop("__longest")


def chunk_passages(
    df: DataFrame, id_column: str, tokens: str, size: int = V.PASSAGE_TOKENS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per passage of at most ``size`` tokens, numbered from 0 within its document."""
    return df.select(
        id_column, *keep, F.posexplode(passages(tokens, size)).alias("passage_no", "passage")
    )


def first_passages(
    df: DataFrame, id_column: str, text: str, size: int = V.PASSAGE_TOKENS, most: int | None = None,
    counter: TokenCounter = count_tokens, splitter: Callable[[Column], Column] = split_tokens,
) -> DataFrame:
    """All passages, or the first ``most`` by document and passage number (numeric ids).

    With ``most``, a running sum of passage counts, bucket by bucket, tells how
    many passages lie before each document; only documents that begin within the
    limit are split into tokens.  ``counter`` and ``splitter`` must agree.
    """
    if most is None:
        tokens = df.select(id_column, splitter(F.col(text)).alias("__tokens"))
        return chunk_passages(tokens, id_column, "__tokens", size)
    pieces = F.ceil(counter(F.col(text)) / size).cast("bigint")
    order = number_order(df, id_column)  # buckets from counts
    counted = df.select(id_column, order.bucket.alias("__bucket"), pieces.alias("__pieces"))
    sums = counted.groupBy("__bucket").agg(F.sum("__pieces").alias("__sum"))
    ahead = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    sums = sums.select(F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy("__bucket").orderBy(id_column).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        counted.join(sums.where(F.col("__ahead") < most), F.col("__bucket") == F.col("__b"))
        .withColumn("__before", F.col("__ahead") + F.coalesce(F.sum("__pieces").over(inside), F.lit(0)))
        .where(F.col("__before") < most).select(id_column, "__before")
    )
    tokens = df.join(placed, id_column).select(id_column, "__before", splitter(F.col(text)).alias("__tokens"))
    chunks = chunk_passages(tokens, id_column, "__tokens", size, ["__before"])
    return chunks.where(F.col("__before") + F.col("passage_no") < most).drop("__before")
