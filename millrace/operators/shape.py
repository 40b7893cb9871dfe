"""Raw question sets to the canonical question row, and other reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.choices import (
    choice_at, index_in, letter_of, position_or_minus_one, sampled_choices, shuffled,
    strip_letter_prefixes,
)
from ..functions.prompts import answer_passage, hint_passage, support_passage
from ..functions.text import append_answer, as_column, blank_to_empty, last_question, trim_ws


def retain_fields(df: DataFrame, fields: Sequence[str] = V.MCQ_FIELDS) -> DataFrame:
    """Keep the named columns; names the table does not have are ignored."""
    return df.select(*[c for c in fields if c in df.columns])


def drop_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.drop(*fields)


def tag_source(df: DataFrame, name: str, column: str = "dataset") -> DataFrame:
    return df.withColumn(column, F.lit(name))


def prefixed_id(prefix: str, row_id: str) -> Column:
    return F.concat(F.lit(prefix), F.col(row_id).cast("string"))


def union_sources(tables: Sequence[DataFrame], drop: Sequence[str] = ()) -> DataFrame:
    """All rows of all tables, columns matched by name and filled with nulls."""
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return joined.drop(*drop)


def _carried(df: DataFrame, row_id: str) -> list[str]:
    return [c for c in (row_id, "split") if c in df.columns]


def from_sciq(df: DataFrame, row_id: str = "row_id", seed: int | str = V.SEED) -> DataFrame:
    """Three distractors and the correct answer, shuffled."""
    options = shuffled(
        F.array("distractor1", "distractor2", "distractor3", "correct_answer"), seed, row_id
    )
    return df.withColumn("choices", options).select(
        *_carried(df, row_id), prefixed_id("sciq_", row_id).alias("question_id"), "question", "choices",
        letter_of(index_in("choices", "correct_answer")).alias("answer"),
        blank_to_empty("support").alias("rationale"), F.lit("sciq").alias("dataset"),
    )


def from_aqua(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Option letters removed, the answer appended to the rationale."""
    return df.select(
        *_carried(df, row_id), prefixed_id("aqua_rat", row_id).alias("question_id"), "question",
        strip_letter_prefixes("options").alias("choices"), F.col("correct").alias("answer"),
        append_answer("rationale", "correct").alias("rationale"),
    )


def _labelled(df: DataFrame, question: str, row_id: str, prefix: Column, seed: int | str) -> DataFrame:
    texts = F.col("choices.text")
    position = index_in("choices.label", "answerKey")
    correct = F.when(position >= 0, choice_at(texts, position))
    final = F.when(F.size(texts) > 4, sampled_choices(texts, position, seed, row_id)).otherwise(texts)
    return df.withColumns({"__correct": correct, "__final": final}).select(
        *_carried(df, row_id), F.concat(prefix, F.col(row_id).cast("string")).alias("question_id"),
        F.col(question).alias("question"), F.col("__final").alias("choices"),
        letter_of(index_in("__final", "__correct")).alias("answer"),
    )


def has_key() -> Column:
    """The answer key is one of the labels and its text is there."""
    position = index_in("choices.label", "answerKey")
    return F.coalesce((position >= 0) & (position < F.size("choices.text")), F.lit(False))


def without_key(df: DataFrame) -> DataFrame:
    """The rows that ``from_arc`` and ``from_openbook`` reject: no text for their answer key."""
    return df.where(~has_key())


def from_arc(df: DataFrame, row_id: str = "row_id", dataset: str = "ai2_arc_challenge", seed: int | str = V.SEED) -> DataFrame:
    """Correct text found by its label; more than four choices cut to four.

    Rows whose key is not among the labels are rejected, see ``without_key``.
    """
    df = df.where(has_key())
    return _labelled(df, "question", row_id, F.lit(f"{dataset}_"), seed).withColumn("dataset", F.lit(dataset))


def from_openbook(df: DataFrame, row_id: str = "row_id", seed: int | str = V.SEED) -> DataFrame:
    df = df.where(has_key())
    prefix = F.concat(F.col("split"), F.lit("_")) if "split" in df.columns else F.lit("openbookqa_")
    return _labelled(df, "question_stem", row_id, prefix, seed)


def from_medmcqa(df: DataFrame, row_id: str = "row_id", seed: int | str = V.SEED) -> DataFrame:
    """Rows with a valid single answer index (see ``rules.is_single_choice``)."""
    options = F.array(*[blank_to_empty(c) for c in ("opa", "opb", "opc", "opd")])
    position = trim_ws(F.col("cop").cast("string")).try_cast("int")
    return df.withColumns(
        {"choices": shuffled(options, seed, row_id), "__correct": choice_at(options, position)}
    ).select(
        *_carried(df, row_id), prefixed_id("medmcqa_", row_id).alias("question_id"), "question", "choices",
        letter_of(index_in("choices", "__correct")).alias("answer"),
        F.col("exp").alias("rationale"), "subject_name", F.lit("medmcqa").alias("dataset"),
    )


def four_choices(df: DataFrame, row_id: str = "row_id", seed: int | str = V.SEED) -> DataFrame:
    """Correct choice and three sampled others, shuffled and re-lettered.

    Rows stay unchanged where the answer points past the choices or fewer than
    three others exist.
    """
    position = (F.ascii("answer") - 65).cast("int")
    usable = (position >= 0) & (position < F.size("choices")) & (F.size("choices") >= 4)
    wide = df.withColumns(
        {
            "__correct": choice_at("choices", position),
            "__new": F.when(usable, sampled_choices("choices", position, seed, row_id)),
        }
    )
    changed = F.col("__new").isNotNull()
    return wide.withColumns(
        {
            "choices": F.coalesce("__new", "choices"),
            "answer": F.when(changed, letter_of(index_in("__new", "__correct"))).otherwise(F.col("answer")),
        }
    ).drop("__correct", "__new")


def from_math_preferences(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Few-shot prompts reduced to their last question."""
    return df.withColumns(
        {
            "prompt": last_question("prompt"),
            "dataset": F.lit("metamath"),
            "id": prefixed_id("metamath", row_id),
        }
    ).drop("system", "question")


def from_code_preferences(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The question becomes the prompt."""
    prompt = F.col("question") if "question" in df.columns else F.col("prompt")
    return df.withColumns(
        {"prompt": prompt, "dataset": F.lit("codealpaca"), "id": prefixed_id("codealpaca", row_id)}
    ).drop("system", "question")


def keyed_choice(choices: str = "choices.text", answer: str = "answerKey") -> Column:
    """Choice by answer letter; any other key takes the last choice."""
    return choice_at(as_column(choices), position_or_minus_one(answer))


def sciq_passages(df: DataFrame) -> DataFrame:
    return df.select(
        support_passage("question", "support", "correct_answer").alias("text"), F.lit(V.SCIQ).alias("source")
    )


def hint_passages(df: DataFrame, source: str = V.PUBMED, question: str = "question", hint: str = "answer") -> DataFrame:
    return df.select(hint_passage(question, hint).alias("text"), F.lit(source).alias("source"))


def keyed_passages(df: DataFrame, source: str) -> DataFrame:
    return df.select(answer_passage("question", keyed_choice()).alias("text"), F.lit(source).alias("source"))


def answer_passages(df: DataFrame, source: str = V.AQUA, question: str = "question", answer: str = "answer") -> DataFrame:
    return df.select(answer_passage(question, answer).alias("text"), F.lit(source).alias("source"))


def context_pairs(df: DataFrame, source: str, context: Column | str, question: str = "question") -> DataFrame:
    """``question, context, source`` rows for encoder training."""
    return df.select(
        F.col(question).alias("question"), as_column(context).alias("context"), F.lit(source).alias("source")
    )


def evaluation_rows(df: DataFrame, name: str = V.EVAL_SET) -> DataFrame:
    return df.select(
        F.lit(name).alias("id"), "question", F.col("options").alias("choices"), "answer"
    )


def comparison_rows(df: DataFrame, row_id: str, before: str, after: str) -> DataFrame:
    return df.where(trim_ws(before) != trim_ws(after)).select(
        F.col(row_id).alias("question_id"), F.col(before).alias("original"), F.col(after).alias("cleaned")
    )
