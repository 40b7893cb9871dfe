"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import id_hash, query, table, with_arrays

WORD = re.compile(r"[^\W_]+")
BUCKETS, SIZE = 1 << 17, 8  # subword vectors
SHORTEST, LONGEST = 3, 5  # lengths of the subwords
WINDOW, STEP = 8, 4  # words whose vectors are averaged; windows overlap by half
ROWS_PER_CLASS = {1: 3000, 0: 6000}  # expected number of labelled rows that are learned from
EPOCHS, RATE, DECAY = 80, 0.05, 1e-5
THRESHOLD = 0.7
REMEMBERED = 400_000  # words a task keeps the value of


def subwords(word: str) -> list[int]:
    """Buckets of a word: of itself and of its character n-grams, with its borders marked."""
    data = f"<{word}>"
    found = [crc32(data.encode("utf-8", "surrogatepass"))]
    for size in range(SHORTEST, LONGEST + 1):
        found += [crc32(data[i : i + size].encode("utf-8", "surrogatepass")) for i in range(len(data) - size + 1)]
    return [value % BUCKETS for value in found]


def window_borders(words: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the stretches that are averaged: windows, or the whole text."""
    if whole:
        return np.zeros(1, int), np.full(1, words)
    starts = np.arange(0, max(1, words - WINDOW + STEP), STEP)
    return starts, np.minimum(starts + WINDOW, words)


def train(texts: list[str], toxic: np.ndarray, seed: int = 7, whole: bool = False) -> tuple[np.ndarray, float]:
    """Learn subword vectors and the softmax together; returns each bucket's log-odds and the bias.

    With ``whole`` there is one window, the text.  A few toxic words then weigh little in a long
    text (README has both figures), which is why windows are the default.

    A window's vector is the mean over its words of the mean over their
    subwords; a softmax over it says how likely the window is toxic.  A text is
    toxic if any window is: one minus the product of what the windows leave.
    Full-batch Adam on the cross entropy.  Since all is linear up to the
    softmax, a bucket's share in the log-odds is one number.
    """
    place: dict[str, int] = {}
    words, starts, ends, of_text, at = [], [], [], [], 0
    for number, text in enumerate(texts):
        own = WORD.findall(text.lower())
        if not own:
            continue
        words.append(np.array([place.setdefault(w, len(place)) for w in own], np.int32))
        low, high = window_borders(len(own), whole)
        starts.append(low + at)
        ends.append(high + at)
        of_text.append(np.full(len(low), number))
        at += len(own)
    if not words or len(set(toxic.tolist())) < 2:
        share = float(toxic.mean()) if len(toxic) else 0.0
        share = min(max(share, 0.001), 0.999)
        return np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    words, starts, ends, of_text = map(np.concatenate, (words, starts, ends, of_text))
    parts = [subwords(word) for word in place]
    sizes = np.array([len(p) for p in parts])
    flat = np.concatenate([np.array(p, np.int32) for p in parts])
    owner = np.repeat(np.arange(len(parts)), sizes)
    weight = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum()))
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.01, (BUCKETS, SIZE))
    softmax = random.normal(0, 0.5, (SIZE, 2))
    bias = np.array([0.0, -6.0])
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (vectors, softmax, bias)]
    length = ends - starts
    for epoch in range(1, EPOCHS + 1):
        odds = vectors @ (softmax[:, 1] - softmax[:, 0])  # per bucket
        per_word = np.bincount(owner, odds[flat], len(parts)) / sizes
        sums = np.concatenate(([0.0], np.cumsum(per_word[words])))
        z = WINDOW * (sums[ends] - sums[starts]) / length + bias[1] - bias[0]
        clean = np.bincount(of_text, np.logaddexp(0, z), len(texts))  # -log of what the windows leave
        risk = 1 - np.exp(-np.maximum(clean, 1e-9))
        slope = np.where(toxic == 1, -(1 - risk) / np.maximum(risk, 1e-9), 1.0) * weight
        grad = slope[of_text] / (1 + np.exp(-z))
        steps = np.zeros(len(words) + 1)
        np.add.at(steps, starts, WINDOW * grad / length)
        np.subtract.at(steps, ends, WINDOW * grad / length)
        by_word = np.bincount(words, np.cumsum(steps[:-1]), len(parts)) / sizes
        by_bucket = np.bincount(flat, by_word[owner], BUCKETS)
        total = grad.sum()
        turn = by_bucket @ vectors
        grads = (
            np.outer(by_bucket, softmax[:, 1] - softmax[:, 0]) + DECAY * vectors,
            np.stack((-turn, turn), 1), np.array([-total, total]),
        )
        for value, own, (first, second) in zip((vectors, softmax, bias), grads, state, strict=True):
            first += 0.1 * (own - first)
            second += 0.001 * (own * own - second)
            value -= RATE * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.999**epoch)) + 1e-8)
    return vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, whole: bool = False) -> tuple[np.ndarray, float]:
    """Fit on the labelled rows (labels: doc_id, toxic); one task trains on a bounded sample of them.

    A document's rows are drawn by a hash of its id at a rate that expects at
    most ``ROWS_PER_CLASS`` rows of a class; contradicting labels count as toxic.
    Null texts and labels teach nothing.
    """
    wanted = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in wanted.groupBy("toxic").count().collect()}
    rates = {kind: min(1.0, ROWS_PER_CLASS[kind] / n) for kind, n in totals.items()}
    if not rates:
        return np.zeros(BUCKETS), -6.0
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    drawn = F.broadcast(wanted.where(draw < rate[F.col("toxic")]))  # some 9 000 ids, see ROWS_PER_CLASS
    sample = docs.where((draw < max(rates.values())) & F.col("text").isNotNull()).join(drawn, "doc_id").select("doc_id", "text", "toxic")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        odds, bias = train(rows["text"].tolist(), rows["toxic"].to_numpy(), whole=whole)
        return pd.DataFrame({"odds": [odds.astype(np.float32).tobytes()], "bias": [bias]})

    row = sample.groupBy().applyInPandas(fit, "odds binary, bias double").first()
    return (np.frombuffer(row["odds"], np.float32), row["bias"]) if row else (np.zeros(BUCKETS), -6.0)


def score(docs: DataFrame, odds: np.ndarray, bias: float, text: str = "text", whole: bool = False) -> DataFrame:
    """Add ``score`` and ``predicted`` to every row, in place of columns of these names; nothing is shuffled.

    A null or empty text, or one without a word, is a single window of no
    evidence.  Repeated rows score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(odds, np.float64))  # BUCKETS numbers

    def make():
        values, known = shared.value, {}

        def of_word(word: str) -> float:
            value = known.get(word)
            if value is None:
                if len(known) > REMEMBERED:
                    known.clear()
                value = known[word] = float(values[subwords(word)].mean())
            return value

        def run(batch):
            scores = []
            for value in batch.column(text).to_pylist():
                words = WORD.findall(value.lower()) if value else []
                sums = np.concatenate(([0.0], np.cumsum([of_word(word) for word in words])))
                low, high = window_borders(len(words), whole)
                z = WINDOW * (sums[high] - sums[low]) / np.maximum(1, high - low) + bias
                scores.append(float(1 - np.exp(-np.logaddexp(0, z).sum())))
            return scores, [int(s >= THRESHOLD) for s in scores]

        return run

    return with_arrays(docs, {"score": "double", "predicted": "int"}, make)


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic every document is."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = id_hash(F.col("doc_id"), 3) == 1
    odds, bias = learn(docs.where(~held_out), labels.where(~held_out))
    return score(docs.select("doc_id", "text", held_out.alias("held_out")), odds, bias).drop("text")
