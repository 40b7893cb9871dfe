"""Text clean-up as Column expressions (no Python worker)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def using(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), build), 1)


def replace_each(text: ColumnLike, replacements: dict[str, str]) -> Column:
    return reduce(
        lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])),
        replacements.items(), as_column(text),
    )


def trim_ws(text: ColumnLike) -> Column:
    """Strip every Unicode whitespace character, not just the space."""
    return F.btrim(as_column(text), F.lit(V.WHITESPACE))


def blank_to_empty(text: ColumnLike) -> Column:
    return F.coalesce(as_column(text), F.lit(""))


def is_blank(text: ColumnLike) -> Column:
    """Null, empty and whitespace-only all count as blank."""
    return trim_ws(blank_to_empty(text)) == ""


def canonicalize(text: ColumnLike) -> Column:
    """Lower case, numbers replaced by a mark, single spaces, edge punctuation removed."""
    lowered = F.lower(as_column(text))
    numbered = F.regexp_replace(lowered, V.NUMBER, V.NUMBER_MARK)
    return F.btrim(F.regexp_replace(numbered, V.SPACE_RUN, " "), F.lit(V.CANONICAL_EDGE))


def normalize_spaces(text: ColumnLike) -> Column:
    return F.regexp_replace(trim_ws(text), V.SPACE_RUN, " ")


def append_answer(rationale: ColumnLike, answer: ColumnLike) -> Column:
    """Replace the last line (if there is more than one) by a stated answer.

    A single line keeps its edges; otherwise the rest is stripped.
    """
    text = as_column(rationale)
    last_line = F.substring_index(text, "\n", -1)
    above = trim_ws(F.left(text, F.length(text) - F.length(last_line) - 1))
    body = F.when(F.contains(text, F.lit("\n")), above).otherwise(text)
    return F.concat(body, F.lit("\nThe answer is: "), as_column(answer))


def _delete_around(text: Column, label: Column, before: str, after: str = "") -> Column:
    """Delete ``before + label + after``; Spark recompiles only when the label changes."""
    pattern = F.concat(F.lit(before + r"\Q"), label, F.lit(r"\E" + after))
    return F.regexp_replace(text, pattern, F.lit(""))


def strip_answer_statements(rationale: ColumnLike, label: ColumnLike) -> Column:
    """Delete the three ways of stating the answer letter.

    Literal on purpose: nothing is required after the letter, so ``answer: all``
    with label A loses ``answer: a``.
    """
    text, label = as_column(rationale), as_column(label)
    first, *others = ["(?iu)" + before for before in V.ANSWER_STATEMENTS]
    # a word that every match contains is looked for before the costly patterns run
    correct = F.rlike(text, F.lit("(?iu)" + V.CORRECT_WORD))
    answer = F.rlike(text, F.lit("(?iu)" + V.ANSWER_WORD))
    start = F.when(correct, _delete_around(text, label, first)).otherwise(text)
    deleted = reduce(lambda acc, before: _delete_around(acc, label, before), others, start)
    return trim_ws(F.when(answer, deleted).otherwise(text))


def strip_ans_letter(rationale: ColumnLike, label: ColumnLike) -> Column:
    """Delete ``Ans X`` (case-sensitive) and the line end after it."""
    return trim_ws(_delete_around(as_column(rationale), as_column(label), *V.ANS_LETTER))


def strip_solution_prefix(text: ColumnLike, word_boundary: bool = False) -> Column:
    """Delete a leading ``solution:``/``sol.``/``explanation:``/``expl``.

    By default no word boundary is required (``Solving`` becomes ``ving``).
    """
    edge = V.NOT_BEFORE_WORD if word_boundary else ""
    pattern = "(?iu)" + V.SOLUTION_PREFIX + edge + V.SOLUTION_PREFIX_TAIL
    return F.regexp_replace(as_column(text), pattern, "")


def strip_explanation_prefix(text: ColumnLike) -> Column:
    return F.regexp_replace(as_column(text), "(?iu)" + V.EXPLANATION_PREFIX, "")


def normalize_dashes(text: ColumnLike) -> Column:
    return replace_each(text, {"–": "-", "—": "-"})


def remove_answer_mention(text: ColumnLike, word_boundary: bool = False) -> Column:
    """Delete a leading answer statement, then leading punctuation."""
    edge = V.NOT_BEFORE_WORD if word_boundary else ""
    answer = "(?iu)" + V.LEADING_ANSWER[0] + edge + V.LEADING_ANSWER[1]
    without = trim_ws(F.regexp_replace(as_column(text), answer, ""))
    return trim_ws(F.regexp_replace(without, V.LEADING_PUNCTUATION, ""))


def soften_quotes(text: ColumnLike, newlines: bool = False) -> Column:
    """Double quotes to single quotes; optionally newlines to spaces."""
    return replace_each(text, {'"': "'", "\n": " "} if newlines else {'"': "'"})


def after_last(text: ColumnLike, mark: str) -> Column:
    """The part after the last ``mark``; the whole text where it is absent."""
    return F.substring_index(as_column(text), mark, -1)


def last_question(prompt: ColumnLike) -> Column:
    """The question of the last few-shot block.

    Takes the last blank-line separated paragraph and, inside it, the text from
    the first ``Question:`` to the first ``Answer:``.  Where ``Answer:`` comes
    first the result is empty.  Blank prompts stay as they are.
    """
    raw = as_column(prompt)

    def question_of(paragraph: Column) -> Column:
        start = F.locate("Question:", paragraph) + len("Question:")
        stop = F.locate("Answer:", paragraph)
        between = F.when(
            stop > 0, F.substr(paragraph, start, F.greatest(F.lit(0), stop - start))
        ).otherwise(F.substr(paragraph, start))
        return F.when(F.contains(paragraph, F.lit("Question:")), trim_ws(between)).otherwise(paragraph)

    last_paragraph = trim_ws(F.element_at(F.split(trim_ws(raw), "\n\n"), -1))
    return F.when(F.length(raw) > 0, using(last_paragraph, question_of)).otherwise(raw)
