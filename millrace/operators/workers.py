"""User functions on Arrow batches: predicates, encoders, text writers.

The functions defined here are closures, so executors need the caller's
function but not this package.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V


def batch_predicate(rule: Callable[..., Sequence[bool]]) -> Callable[..., Column]:
    """A boolean Column from ``rule(list, list, ...) -> list of bool``.

    A batch on which the rule fails is retried row by row; failing rows are False.
    """

    @F.pandas_udf("boolean")
    def flags(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            lists = [c.tolist() for c in (columns if isinstance(columns, tuple) else (columns,))]
            try:
                found = list(rule(*lists))
            except Exception:
                found = []
                for row in zip(*lists):
                    try:
                        found.append(bool(rule(*[[value] for value in row])[0]))
                    except Exception:
                        found.append(False)
            yield pd.Series(found, dtype="bool")

    return lambda *columns: flags(*columns)


def embed(
    df: DataFrame, text: str, encode: Callable[[list[str]], "np.ndarray"],
    batch: int = V.ENCODE_BATCH, name: str = "embedding",
) -> DataFrame:
    """Add an embedding column from ``encode(texts) -> matrix``, ``batch`` texts at a time."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.FloatType()))])

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                matrix = np.asarray(encode(part[text].fillna("").tolist()), dtype="float32")
                yield part.assign(**{name: list(matrix)})

    return df.mapInPandas(encoded, schema)


def enrich(
    df: DataFrame, request: str, write: Callable[[str], str], name: str = "rationale",
    retries: int = 3, wait: float = 2.0,
) -> DataFrame:
    """Add a generated text per row from ``write(request) -> text``.

    Tried up to ``retries`` times with a pause between; a row that keeps failing
    gets an empty text instead of failing the job.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    def written(prompt: str) -> str:
        for attempt in range(retries):
            try:
                return (write(prompt) or "").strip()
            except Exception:
                if attempt + 1 < retries:
                    time.sleep(wait)
        return ""

    def filled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{name: [written(prompt) for prompt in frame[request]]})

    return df.mapInPandas(filled, schema)


def _asked(write: Callable[[str], str], retries: int, wait: float, growth: float) -> Callable[[str], tuple[str | None, int, str | None]]:
    """``request -> (text, tries, error)``; pauses grow from one try to the next, with up to a half more by chance."""

    def ask(request: str) -> tuple[str | None, int, str | None]:
        error = None
        for attempt in range(1, retries + 1):
            try:
                return (write(request) or "").strip(), attempt, None
            except Exception as raised:  # noqa: BLE001 - whatever the caller's function raises
                error = f"{type(raised).__name__}: {raised}"
                if attempt < retries:
                    time.sleep(wait * growth ** (attempt - 1) * (1 + random.random() / 2))
        return None, retries, error

    return ask


def enrich_resumed(
    df: DataFrame, row_id: str, request: str, write: Callable[[str], str], path: str, name: str = "rationale",
    parallel: int = 8, retries: int = 3, wait: float = 2.0, growth: float = 2.0, wave_rows: int = 10_000,
) -> DataFrame:
    """Add a generated text per row, keeping what has been written under ``path``: ``name``, ``tries`` and ``error``.

    Rows go in waves of about ``wave_rows``, by a hash of their id; a wave is stored
    before the next begins.  Run again, after a stop or with more rows, only rows without a stored answer
    are sent.  A task has up to ``parallel`` requests under way; answers stay in the order of the rows.  A row that keeps
    failing gets a null text and its error, is not tried again, and does not stop the others; delete its answer to do so.
    Ids are unique.  Rows with a null request get a null text without being sent.
    """
    spark = df.sparkSession
    schema = T.StructType([T.StructField("__id", df.schema[row_id].dataType), *T.StructType.fromDDL(f"`{name}` string, tries int, error string").fields])
    answers = f"{path.rstrip('/')}/answers"

    def stored() -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(answers)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def filled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = _asked(write, retries, wait, growth)
        with ThreadPoolExecutor(parallel) as pool:
            for frame in frames:
                found = list(pool.map(lambda r: (None, 0, None) if r is None else ask(r), frame["__request"].tolist()))
                yield pd.DataFrame({"__id": frame["__id"], name: [f[0] for f in found], "tries": [f[1] for f in found], "error": [f[2] for f in found]})

    asked = df.select(F.col(row_id).alias("__id"), F.col(request).alias("__request"))
    missing = asked.join(stored(), "__id", "left_anti")
    waves = -(-missing.count() // wave_rows)
    wave = F.pmod(F.xxhash64("__id"), F.lit(max(1, waves)))
    for number in range(waves):
        # what is stored is left out again: a wave that another attempt finished is not sent twice
        part = asked.where(wave == number).join(stored(), "__id", "left_anti")
        part.mapInPandas(filled, schema).write.mode("append").parquet(answers)
    return df.join(stored(), F.col(row_id) == F.col("__id"), "left").drop("__id")
