"""Prompts, completions and passages built from question columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .choices import choice_at, letter_of, position_of
from .text import ColumnLike, as_column, blank_to_empty, soften_quotes, trim_ws


SHOWN = 4  # choices in a quiz prompt


def lettered(choices: ColumnLike, mark: str) -> Column:
    """``A<mark>choice`` for every choice."""
    return F.transform(
        as_column(choices), lambda c, i: F.concat(letter_of(i), F.lit(mark), c)
    )


def quiz_prompt(question: ColumnLike, choices: ColumnLike) -> Column:
    """Preamble, question and up to four lettered choices, one per line."""
    lines = F.transform(
        lettered(F.slice(as_column(choices), 1, SHOWN), ". "),
        lambda line: F.concat(F.lit(" "), line, F.lit("\n")),
    )
    return F.concat(
        F.lit(V.QUIZ_PREAMBLE + "Question: "), trim_ws(question), F.lit("\n"),
        F.array_join(lines, ""), F.lit("\nAnswer:"),
    )


def quiz_completion(choices: ColumnLike, answer: ColumnLike, rationale: ColumnLike) -> Column:
    """Letter, choice and rationale; null where the answer is not one of the choices that the prompt shows."""
    position = position_of(answer)
    position = F.when(position < SHOWN, position)
    return F.concat(
        F.lit(" "), letter_of(position), F.lit(". "), choice_at(choices, position),
        F.lit("\nExplanation: "), trim_ws(rationale),
    )


def plain_prompt(question: ColumnLike, choices: ColumnLike) -> Column:
    return F.concat(
        F.lit("Question: "), as_column(question), F.lit("\nChoices:\n"),
        F.array_join(lettered(choices, ". "), "\n"), F.lit("\nAnswer:"),
    )


def plain_completion(choices: ColumnLike, answer: ColumnLike, rationale: ColumnLike) -> Column:
    """Letter and choice text; the letter alone where it points past the choices."""
    letter, options = as_column(answer), as_column(choices)
    position = F.ascii(F.upper(letter)) - 65
    choice = F.when(
        (position >= 0) & (position < F.size(options)),
        F.concat(F.lit(". "), choice_at(options, position)),
    ).otherwise("")
    return F.concat(letter, choice, F.lit("\nExplanation: "), blank_to_empty(rationale))


def rationale_request(question: ColumnLike, choices: ColumnLike, answer: ColumnLike) -> Column:
    """The block a rationale writer is asked to complete."""
    return F.concat(
        F.lit("Question: "), as_column(question), F.lit("\nChoices:\n"),
        F.array_join(lettered(choices, ") "), "\n"),
        F.lit("\nAnswer: "), as_column(answer), F.lit("\nExplanation:"),
    )


def verification_request(original: ColumnLike, cleaned: ColumnLike) -> Column:
    return F.concat(
        F.lit(V.VERIFY_HEAD), as_column(original), F.lit(V.VERIFY_MIDDLE), as_column(cleaned),
        F.lit(V.VERIFY_TAIL),
    )


def answer_passage(question: ColumnLike, answer: ColumnLike) -> Column:
    return F.concat(F.lit(V.RELATED_ANSWER), as_column(question), F.lit(" A: "), as_column(answer))


def hint_passage(question: ColumnLike, hint: ColumnLike) -> Column:
    return F.concat(F.lit(V.RELATED_HINT), as_column(question), F.lit(" H: "), as_column(hint))


def support_passage(question: ColumnLike, support: ColumnLike, correct: ColumnLike) -> Column:
    return F.concat(
        answer_passage(question, support), F.lit("\nThe answer is "), as_column(correct)
    )


def hint_candidate(question: ColumnLike, hint: ColumnLike) -> Column:
    """Text to embed for a question with paragraphs; no space after the first mark."""
    return F.concat(
        F.lit(V.RELATED_HINT_UNSPACED), soften_quotes(question), F.lit(" H: "), soften_quotes(hint)
    )


def answer_candidate(question: ColumnLike, answer: ColumnLike) -> Column:
    return answer_passage(soften_quotes(question, newlines=True), soften_quotes(answer, newlines=True))


def joined_paragraphs(paragraphs: ColumnLike) -> Column:
    return F.array_join(as_column(paragraphs), " ")
