"""The retrieval corpus: diverse examples, passages, training pairs, search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.prompts import answer_candidate, hint_candidate, joined_paragraphs
from ..functions.rules import has_text, keeps_in_corpus
from ..functions.text import soften_quotes
from ..functions.tokens import TokenCounter, count_tokens, split_tokens
from ..operators.columns import computed_once
from ..operators.filtering import within_budget
from ..operators.nearest import best_rows, diverse_rows
from ..operators.order import seeded_shuffle
from ..operators.sequences import first_passages
from ..operators.shape import (
    answer_passages, context_pairs, hint_passages, keyed_choice, keyed_passages, sciq_passages,
    union_sources,
)


def hint_candidates(
    raw: DataFrame, row_id: str = "row_id", counter: TokenCounter = count_tokens, limit: int = V.PASSAGE_TOKENS
) -> DataFrame:
    """Questions with joined paragraphs that fit the encoder: ``row_id, question, answer, text``."""
    hint = joined_paragraphs("context.contexts")
    candidates = raw.select(
        row_id, soften_quotes("question").alias("question"), soften_quotes(hint).alias("answer"),
        hint_candidate("question", hint).alias("text"),
    )
    return within_budget(candidates, "text", limit, counter).drop("tokens")


def answer_candidates(
    raw: DataFrame, row_id: str = "row_id", counter: TokenCounter = count_tokens, limit: int = V.PASSAGE_TOKENS
) -> DataFrame:
    """Cleaned question and rationale pairs that fit the encoder."""
    candidates = raw.where(F.col("was_cleaned")).select(
        row_id, soften_quotes("question", newlines=True).alias("question"),
        soften_quotes("rationale", newlines=True).alias("answer"),
        answer_candidate("question", "rationale").alias("text"),
    )
    return within_budget(candidates, "text", limit, counter).drop("tokens")


def selected_examples(
    candidates: DataFrame, row_id: str = "row_id", vector: str = "embedding", k: int = V.CLUSTERS,
    iterations: int = V.CLUSTER_ITERATIONS, seed: int = V.SEED,
) -> DataFrame:
    """``question, answer`` of the row nearest to each cluster center."""
    picks = diverse_rows(candidates, row_id, vector, k, iterations, seed)
    return candidates.join(picks.select(row_id), row_id).select("question", "answer")


def passage_corpus(
    sciq: DataFrame, pubmed: DataFrame, arc_easy: DataFrame, arc_challenge: DataFrame, aqua: DataFrame,
    counter: TokenCounter = count_tokens, strict: bool = False,
) -> DataFrame:
    """Templated passages of the five sources, ``text, source``, filtered by length."""
    passages = union_sources(
        [
            sciq_passages(sciq.where(has_text("support"))),
            hint_passages(pubmed),
            keyed_passages(arc_easy, V.ARC_EASY),
            keyed_passages(arc_challenge, V.ARC_CHALLENGE),
            answer_passages(aqua),
        ]
    )
    texts = computed_once(passages, text=F.col("text"))
    return texts.where(keeps_in_corpus("text", counter(F.col("text")), strict=strict)).select("text", "source")


def training_pairs(
    sciq: DataFrame, pubmed: DataFrame, arc_easy: DataFrame, arc_challenge: DataFrame, aqua: DataFrame,
) -> DataFrame:
    """``question, context, source`` of the five sources."""
    return union_sources(
        [
            context_pairs(sciq.where(has_text("support")), V.SCIQ, "support"),
            context_pairs(pubmed, V.PUBMED, "answer"),
            context_pairs(arc_easy, V.ARC_EASY, keyed_choice()),
            context_pairs(arc_challenge, V.ARC_CHALLENGE, keyed_choice()),
            context_pairs(aqua, V.AQUA, "answer"),
        ]
    )


def encoder_input(pairs: DataFrame, id_column: str, seed: int = V.SEED) -> DataFrame:
    """(question, passage) rows with a passage, in seeded order."""
    return seeded_shuffle(pairs.where(has_text("context")), id_column, seed).select("question", "context")


def searchable_passages(
    documents: DataFrame, id_column: str, text: str, size: int = V.PASSAGE_TOKENS, most: int | None = None,
    counter: TokenCounter = count_tokens, splitter=split_tokens,
) -> DataFrame:
    """The passages of a corpus, all or the first ``most``: ``id, passage_no, passage`` (token list)."""
    return first_passages(documents, id_column, text, size, most, counter, splitter)


def retrieve(
    corpus: DataFrame, queries: DataFrame, corpus_id: str, query_id: str, corpus_value: str,
    query_value: str, similarity: str = "cosine", k: int = 1,
) -> DataFrame:
    return best_rows(corpus, queries, corpus_id, query_id, corpus_value, query_value, similarity, k)
