"""Row predicates as boolean Columns; never null, so ``~rule`` is the complement."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as V
from .text import ColumnLike, after_last, as_column, blank_to_empty, is_blank, trim_ws


def _matches(text: ColumnLike, pattern: str) -> Column:
    return F.coalesce(F.rlike(as_column(text), F.lit(pattern)), F.lit(False))


def option_list(options: ColumnLike) -> Column:
    """A comma-separated options string as a list of trimmed, non-blank options."""
    pieces = F.transform(F.split(as_column(options), ","), trim_ws)
    return F.filter(pieces, lambda piece: piece != "")


def has_required_fields(
    question: ColumnLike, rationale: ColumnLike, correct: ColumnLike, options: ColumnLike,
    options_as_text: bool = False,
) -> Column:
    """Question, rationale and answer non-blank and at least two options."""
    listed = option_list(options) if options_as_text else as_column(options)
    return (
        ~is_blank(question) & ~is_blank(rationale) & ~is_blank(correct)
        & (F.coalesce(F.size(listed), F.lit(0)) >= 2)
    )


def has_text(text: ColumnLike) -> Column:
    return ~is_blank(text)


def url_in_any_string(df: DataFrame) -> Column:
    """A URL in any top-level string column (array columns are not searched)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return reduce(or_, [_matches(F.col(f"`{name}`"), V.URL) for name in strings], F.lit(False))


def has_loose_url(text: ColumnLike) -> Column:
    return _matches(text, "(?iu)" + V.URL_LOOSE)


def has_figure_reference(text: ColumnLike) -> Column:
    return _matches(text, "(?iu)" + V.FIGURE_WORD) & _matches(text, "(?iu)" + V.FIGURE)


def cites_reference(text: ColumnLike) -> Column:
    """Any of the citation patterns, on lower-cased text, as one regex."""
    # cheapest test first: a possible first letter, then the word edge, then the patterns
    words = f"(?={V.CITATION_START}){V.NOT_AFTER_WORD}(?:{'|'.join(V.CITATIONS)})"
    pattern = f"{words}|{V.CITATION_LINK}"
    return _matches(F.lower(as_column(text)), pattern)


def is_single_choice(choice_type: ColumnLike, answer_index: ColumnLike) -> Column:
    """Single-choice with an answer index of 0 to 3, given as number or digit string."""
    digits = trim_ws(as_column(answer_index).cast("string"))
    in_range = digits.try_cast("int").between(0, 3)
    return (
        F.coalesce(as_column(choice_type) == "single", F.lit(False))
        & F.coalesce(F.rlike(digits, F.lit(f"^{V.D}+$")), F.lit(False))
        & F.coalesce(in_range, F.lit(False))
    )


def is_complete_mcq(question: ColumnLike, choices: ColumnLike, answer: ColumnLike) -> Column:
    """Answer A to D, a question, and exactly four non-empty choices."""
    options = as_column(choices)
    rule = (
        as_column(answer).isin("A", "B", "C", "D")
        & (F.length(as_column(question)) > 0)
        & (F.size(options) == 4)
        & F.forall(options, lambda c: F.length(blank_to_empty(c)) > 0)
    )
    return F.coalesce(rule, F.lit(False))


def has_only_allowed_characters(text: ColumnLike) -> Column:
    """ASCII, the listed symbols, maths symbols, lower-case letters, Greek-named characters."""
    # ASCII is let through by a range test before the classes are looked at
    accepted = rf"{V.EXTRA_ALLOWED}\p{{Sm}}\p{{Ll}}{V.GREEK_NAMED}\p{{IsGreek}}"
    refused = (
        rf"[\x{{80}}-\x{{10ffff}}&&[^{accepted}]]|[\x{{80}}-\x{{10ffff}}&&[{V.GREEK_UNNAMED}]]"
    )
    return ~_matches(text, refused)


def is_long_or_valid_short(
    rationale: ColumnLike, long_from: int = V.SHORT_RATIONALE, min_chars: int = V.MIN_SHORT_RATIONALE
) -> Column:
    """Keep long rationales; keep short ones that hold more than a bare answer.

    The literal rule also looks for an upper-case letter in lower-cased text, which
    can never match and is therefore left out.
    """
    text = as_column(rationale)
    short = F.lower(trim_ws(text))
    valid = (
        (F.length(short) >= min_chars)
        & ~F.contains(short, F.lit("option"))
        & ~F.contains(short, F.lit("correct"))
    )
    return F.coalesce((F.length(text) >= long_from) | valid, F.lit(False))


def within_tokens(count: Column, limit: int) -> Column:
    return F.coalesce(count <= limit, F.lit(False))


def keeps_in_corpus(
    text: ColumnLike, token_count: Column, max_tokens: int = V.PASSAGE_TOKENS,
    min_chars: int = V.MIN_ANSWER_CHARS, strict: bool = False,
) -> Column:
    """Minimum answer length, and a token limit.

    Literal by default: the token limit only reaches texts containing ``"H: "``.
    ``strict`` applies it to every text.
    """
    text = as_column(text)
    hint = F.contains(text, F.lit("H: "))
    long_enough = F.when(hint, F.length(after_last(text, "H: ")) >= min_chars).otherwise(
        F.length(after_last(text, "A: ")) >= min_chars
    )
    limited = F.lit(True) if strict else hint
    # the token count is only evaluated for rows that pass the cheap test
    rule = F.when(long_enough & limited, token_count <= max_tokens).otherwise(long_enough)
    return F.coalesce(rule, F.lit(False))


def is_usable_preference(
    prompt: ColumnLike, chosen: ColumnLike, rejected: ColumnLike, counter,
    max_prompt: int = V.PREFERENCE_PROMPT_TOKENS, max_total: int = V.PREFERENCE_TOTAL_TOKENS,
) -> Column:
    """All three texts non-blank, prompt and longest exchange within the token limits."""
    texts = [trim_ws(blank_to_empty(c)) for c in (prompt, chosen, rejected)]
    complete = (texts[0] != "") & (texts[1] != "") & (texts[2] != "")
    longest = F.greatest(counter(texts[1]), counter(texts[2]))
    return F.when(complete, counter(texts[0]) <= F.least(F.lit(max_prompt), max_total - longest)).otherwise(False)


def fits_total(prompt_tokens: Column, completion_tokens: Column, limit: int = V.PADDED_TOKENS) -> Column:
    """Prompt, completion and one end mark within the limit."""
    return F.coalesce(prompt_tokens + completion_tokens + 1 <= limit, F.lit(False))
