"""The multiple-choice corpus: one plan per source, their union, and the mix.

Raw tables carry ``row_id`` (unique over all splits) and ``split``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.keys import hash_key
from ..functions.prompts import quiz_completion, quiz_prompt
from ..functions.rules import (
    cites_reference, fits_total, has_figure_reference, has_loose_url, has_only_allowed_characters,
    has_required_fields, has_text, is_complete_mcq, is_long_or_valid_short, is_single_choice,
    url_in_any_string,
)
from ..functions.text import (
    normalize_dashes, remove_answer_mention, strip_ans_letter, strip_answer_statements,
    strip_explanation_prefix, strip_solution_prefix,
)
from ..functions.tokens import TokenCounter, count_tokens
from ..operators.columns import computed_once
from ..operators.dedup import drop_repeated_questions
from ..operators.filtering import drop_shortest
from ..operators.joins import attach_text, drop_known_questions, drop_mismatches
from ..operators.sampling import mix_order, mix_sources, weight_of, weighted_resample
from ..operators.shape import (
    four_choices, from_aqua, from_arc, from_medmcqa, from_openbook, from_sciq, retain_fields,
    tag_source, union_sources,
)
from ..operators.splits import drop_split, holdout, top_up_validation
from ..session import staged


def sciq_corpus(raw: DataFrame, row_id: str = "row_id", topup_rows: int = V.SCIQ_TOPUP_ROWS, seed: int = V.SEED) -> DataFrame:
    """Canonical rows with a usable rationale; a fixed number of train rows validate.

    The moved rows leave train, so the two splits do not overlap.
    """
    clean = raw.where(
        has_text("support") & ~has_loose_url("support") & ~has_figure_reference("support")
    )
    rows = staged(from_sciq(clean, row_id, seed), "sciq")
    return top_up_validation(rows, row_id, rows=topup_rows, seed=seed)


def aqua_rows(raw: DataFrame, known: DataFrame, known_question: str = "Problem", row_id: str = "row_id") -> DataFrame:
    """New, complete questions with statements of the answer deleted.

    ``original`` keeps the rationale from before the deletion, for the review.
    """
    valid = has_required_fields("question", "rationale", "correct", "options")
    fresh = drop_known_questions(raw.where(valid), known, "question", known_question)
    rows = from_aqua(fresh, row_id).withColumnRenamed("rationale", "original")
    return computed_once(rows, rationale=strip_answer_statements("original", "answer"))


def aqua_corpus(
    raw: DataFrame, known: DataFrame, verdicts: DataFrame | None = None,
    known_question: str = "Problem", row_id: str = "row_id", share: float = V.AQUA_TOPUP_SHARE,
    match: str = "prefix", seed: int = V.SEED,
) -> DataFrame:
    """Reviewed, cleaned rows with four choices; a share of train validates.

    ``question_id`` of the verdicts is the row id.
    """
    rows = aqua_rows(raw, known, known_question, row_id).drop("original")
    if verdicts is not None:
        rows = drop_mismatches(rows, verdicts, row_id, match=match)
    rows = computed_once(rows, rationale=strip_ans_letter("rationale", "answer"))
    rows = rows.where(~url_in_any_string(rows))
    rows = computed_once(rows, rationale=normalize_dashes(strip_solution_prefix("rationale")))
    rows = rows.where(has_only_allowed_characters("rationale") & is_long_or_valid_short("rationale"))
    kept = retain_fields(rows, (*V.MCQ_FIELDS, row_id, "split"))
    four = staged(four_choices(kept, row_id, seed), "aqua")
    return top_up_validation(four, row_id, share=share, seed=seed)


def medmcqa_corpus(
    raw: DataFrame, row_id: str = "row_id", holdout_rows: int = V.HOLDOUT_ROWS,
    weights: dict[str, float] | None = None, counter: TokenCounter = count_tokens,
    limit: int = V.PADDED_TOKENS, seed: int = V.SEED,
) -> DataFrame:
    """Complete, distinct questions with a substantial rationale; train balanced by subject.

    The table is written three times on the way, each time before several passes
    over a few of its columns.
    """
    weights = V.SUBJECT_WEIGHTS if weights is None else weights
    valid = drop_split(raw.where(is_single_choice("choice_type", "cop")))
    explained = from_medmcqa(valid, row_id, seed)
    rows = computed_once(explained, choices=F.col("choices"), answer=F.col("answer"))
    complete = staged(rows.where(is_complete_mcq("question", "choices", "answer")), "medmcqa-complete")
    distinct = drop_repeated_questions(complete, row_id, within="split")
    usable = distinct.where(has_text("rationale") & ~cites_reference("rationale"))
    cleaned = staged(usable.withColumn("rationale", remove_answer_mention("rationale")), "medmcqa-clean")
    long_enough = drop_shortest(cleaned, "rationale", 0.1, ("split",))
    split = holdout(long_enough, row_id, holdout_rows, seed)
    prompt = quiz_prompt("question", "choices")
    completion = quiz_completion("choices", "answer", "rationale")
    short = staged(split.where(fits_total(counter(prompt), counter(completion), limit)), "medmcqa-short")
    train = short.where(F.col("split") == "train").withColumn("__weight", weight_of("subject_name", weights))
    balanced = weighted_resample(train, row_id, "__weight", seed).drop("__weight", "copy")
    return balanced.unionByName(short.where(F.col("split") != "train"))


def arc_corpus(raw: DataFrame, rationales: DataFrame, row_id: str = "row_id", seed: int = V.SEED) -> DataFrame:
    """Train and validation questions with generated rationales (``question_id, rationale``)."""
    rows = from_arc(drop_split(raw), row_id, seed=seed)
    written = attach_text(rows, rationales, "question_id", "question_id", "rationale")
    return written.withColumn("rationale", strip_explanation_prefix("rationale"))


def openbook_corpus(raw: DataFrame, rationales: DataFrame, row_id: str = "row_id", seed: int = V.SEED) -> DataFrame:
    rows = from_openbook(drop_split(raw), row_id, seed)
    written = attach_text(rows, rationales, "question_id", "question_id", "rationale")
    return tag_source(written, "openbookqa")


def joint_corpus(
    sciq: DataFrame, aqua: DataFrame, medmcqa: DataFrame, arc: DataFrame, openbook: DataFrame,
    row_id: str = "row_id", seed: int = V.SEED,
) -> DataFrame:
    """The five sources as one table of train and validation rows.

    Sorting by ``shuffle_key`` puts the rows of all sources in one seeded order.
    """
    tables = [sciq, tag_source(aqua, "aqua_rat"), medmcqa, arc, openbook]
    joint = union_sources(tables).where(F.col("split").isin("train", "validation"))
    return joint.drop("question_id", "subject_name").withColumn("shuffle_key", hash_key(seed, "dataset", row_id))


def mixed_training(
    joint: DataFrame, row_id: str = "row_id", shares: dict[str, float] | None = None, seed: int = V.SEED
) -> DataFrame:
    """Train rows mixed to fixed shares, as prompt and completion, with a sort key.

    ``joint`` is best a stored table: a few of its columns are read three times.
    """
    mixed = mix_sources(
        joint.where(F.col("split") == "train"), row_id, shares or V.MIX_SHARES, seed=seed
    )
    return mixed.select(
        mix_order(row_id, seed=seed).alias("mix_key"), "dataset",
        quiz_prompt("question", "choices").alias("prompt"),
        quiz_completion("choices", "answer", "rationale").alias("completion"),
    )


def formatted_validation(joint: DataFrame) -> DataFrame:
    """The validation rows of all sources, unmixed, as prompt and completion with a sort key."""
    return joint.where(F.col("split") == "validation").select(
        F.col("shuffle_key"), "dataset", quiz_prompt("question", "choices").alias("prompt"),
        quiz_completion("choices", "answer", "rationale").alias("completion"),
    )
