"""Token counts and token-id sequences.

The built-in counter is a regex over words and single symbols and stays in the
JVM; ids of whole texts by hashing come from Arrow batches, where a token is
hashed once.  A subword tokenizer is brought by the caller as a factory and runs
on Arrow batches, loaded once per Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .text import ColumnLike, as_column, trim_ws

TokenCounter = Callable[[ColumnLike], Column]


def count_tokens(text: ColumnLike) -> Column:
    """Number of words and symbols.

    Every token with the space after it becomes one letter; the length is then
    the count, without building the tokens.
    """
    marks = F.regexp_replace(as_column(text), V.TOKEN_AND_SPACE, "t")
    return F.length(trim_ws(marks))


def split_tokens(text: ColumnLike) -> Column:
    return F.regexp_extract_all(as_column(text), F.lit(V.TOKEN), 0)


def hashed_ids(tokens: ColumnLike, bits: int = 28) -> Column:
    """Token ids by hashing, for use without a vocabulary."""
    digits = bits // 4
    return F.transform(
        as_column(tokens), lambda t: F.conv(F.substring(F.md5(t), 1, digits), 16, 10).cast("int")
    )


@cache
def _character_classes() -> tuple[np.ndarray, np.ndarray]:
    """Where runs of one class begin among all code points, and their classes: 0 space, 1 word, 2 symbol."""
    classes = np.full(0x110000, 2, "uint8")
    valid = [*range(0xD800), *range(0xE000, 0x110000)]
    codes = np.array(valid, "int64")
    for run in re.finditer(r"\w+", "".join(map(chr, valid))):
        classes[codes[run.start() : run.end()]] = 1
    classes[codes[[run.start() for run in re.finditer(f"[{V.LATER_WORD}]", "".join(map(chr, valid)))]]] = 2
    classes[[ord(c) for c in V.WHITESPACE]] = 0
    starts = np.concatenate([[0], np.flatnonzero(np.diff(classes)) + 1])
    return starts, classes[starts]


def hashed_text(text: ColumnLike, most: int | None = None, bits: int = 28) -> Column:
    """``ids`` of a text's first ``most`` tokens (all, if None) and ``size``, its number of tokens; null for a null text.

    The ids are those of ``hashed_ids(split_tokens(text))``.  Arrow batches are cut at the borders of
    character classes, a few MB at once, and every distinct token is hashed once; a task keeps the ids of so many tokens.
    """
    starts, kinds = _character_classes()
    shift, kept, piece, state = 64 - bits // 4 * 4, V.HASHED_TOKENS, V.HASHED_BYTES, {}

    def spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First bytes and ends of all tokens, and how many tokens lie before each row."""
        at = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "uint32")
        if "classes" not in state:
            state["classes"] = np.repeat(kinds, np.diff(np.append(starts, 0x110000)))
        kind = state["classes"][codes]
        first = np.searchsorted(at, rows)  # first characters of rows
        fresh = np.empty(len(kind) + 1, "bool")  # where a character does not go on with the word before it
        fresh[0] = fresh[-1] = True
        np.not_equal(kind[1:], 1, out=fresh[1:-1])
        fresh[1:-1] |= kind[:-1] != 1
        fresh[first] = True
        solid = kind != 0
        begins = np.flatnonzero(solid & fresh[:-1])
        ends = np.flatnonzero(solid & fresh[1:]) + 1
        at = np.append(at, len(data))
        return at[begins], at[ends], np.searchsorted(begins, first)

    def numbers(tokens: pa.Array) -> np.ndarray:
        coded, ids = tokens.dictionary_encode(), state.setdefault("ids", {})
        if len(ids) > kept:
            ids.clear()
        found = []
        for token in coded.dictionary.to_pylist():
            number = ids.get(token)
            if number is None:
                number = ids[token] = int.from_bytes(md5(token, usedforsecurity=False).digest()[:8]) >> shift
            found.append(number)
        return np.array(found, "int32")[coded.indices.to_numpy()]

    def part(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins, ends, before = spans(data, rows)
        sizes = np.diff(before)
        if most is not None and len(begins):
            keep = np.arange(len(begins)) - np.repeat(before[:-1], sizes) < most
            begins, ends = begins[keep], ends[keep]
        if not len(begins):
            return np.empty(0, "int32"), sizes
        inside = np.zeros(len(data) + 1, "int8")
        inside[begins] = 1
        inside[ends] -= 1
        inside = np.cumsum(inside[:-1], dtype="int8").view("bool")
        borders = np.concatenate([[0], np.cumsum(ends - begins)])
        tokens = pa.Array.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(borders.astype("int64")), pa.py_buffer(data[inside])])
        return numbers(tokens), sizes

    @F.arrow_udf("struct<ids array<int>, size int>")
    def hashed(texts: pa.Array) -> pa.Array:
        whole = texts.cast(pa.large_binary())
        null = whole.is_null()
        whole = whole.fill_null(b"")
        _, borders, data = whole.buffers()
        rows = np.frombuffer(borders, "int64", len(whole) + 1, whole.offset * 8) if len(whole) else np.zeros(1, "int64")
        data = np.frombuffer(data or b"", "uint8")
        ids, sizes, start = [np.empty(0, "int32")], [np.empty(0, "int64")], 0
        while start < len(whole):
            end = max(start + 1, int(np.searchsorted(rows, rows[start] + piece, "right")) - 1)
            found = part(data[rows[start] : rows[end]], rows[start : end + 1] - rows[start])
            ids.append(found[0])
            sizes.append(found[1])
            start = end
        size = np.concatenate(sizes)
        ends = np.concatenate([[0], np.cumsum(size if most is None else np.minimum(size, most))])
        lists = pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(np.concatenate(ids)))
        return pa.StructArray.from_arrays([lists, pa.array(size.astype("int32"))], ["ids", "size"], mask=null)

    return hashed(as_column(text))


def token_counter(factory: Callable[[], Callable[[Sequence[str]], Sequence[int]]]) -> TokenCounter:
    """A counter from ``factory() -> (texts -> lengths)``."""

    @F.pandas_udf("int")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = factory()
        for texts in batches:
            yield pd.Series(lengths(texts.fillna("").tolist()), dtype="int32")

    return lambda text: counts(as_column(text))


def token_encoder(factory: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[int]]]]) -> TokenCounter:
    """An encoder from ``factory() -> (texts -> id lists)``."""

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        for texts in batches:
            yield pd.Series([list(ids) for ids in encode(texts.fillna("").tolist())])

    return lambda text: encoded(as_column(text))


def masked_labels(prompt_ids: ColumnLike, other_ids: ColumnLike) -> Column:
    """The mask value for every prompt token, then the other ids."""
    mask = F.array_repeat(F.lit(V.MASK), F.size(as_column(prompt_ids)))
    return F.concat(mask, as_column(other_ids))


def cut(ids: ColumnLike, limit: int) -> Column:
    return F.slice(as_column(ids), 1, limit)


def padded(ids: ColumnLike, length: ColumnLike, fill: int) -> Column:
    """Right-padded to ``length``; longer sequences stay as they are."""
    values = as_column(ids)
    missing = F.greatest(F.lit(0), as_column(length) - F.size(values)).cast("int")
    return F.concat(values, F.array_repeat(F.lit(fill), missing))


def ones(ids: ColumnLike) -> Column:
    return F.array_repeat(F.lit(1), F.size(as_column(ids)))


def passages(tokens: ColumnLike, size: int = V.PASSAGE_TOKENS) -> Column:
    """Consecutive pieces of at most ``size`` tokens; none for an empty list."""
    values = as_column(tokens)
    last = (F.size(values) - 1).cast("int")
    starts = F.when(
        F.size(values) > 0, F.sequence(F.lit(0), last, F.lit(size))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(values, s + 1, size))
