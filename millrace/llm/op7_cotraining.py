"""Quality classifier by co-training: a text view and a metadata view teach each other."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import query, table, with_arrays

#: Character classes: lower, upper, digit, space, line end, control, other; punctuation has 17 classes of its own.
CLASSES = 24
TEXT_SIZE, META_SIZE = CLASSES * CLASSES + 6, 64 + 24
ROWS = 6000  # expected labelled rows that are learned from, and as many unlabelled ones
ROUNDS, SHARE, SURE = 5, 0.05, 0.9  # rounds; part of the unlabelled rows a view labels per round and class; least confidence
CALIBRATE = 5  # one in so many labelled rows only calibrates
THRESHOLD = 0.5
WORD = re.compile(r"\S+")


def _class_codes() -> np.ndarray:
    codes = np.full(256, 6, np.uint8)
    codes[:32] = 5
    for byte in range(33, 127):
        codes[byte] = 7 + byte % 17
    codes[97:123], codes[65:91], codes[48:58], codes[32], codes[10] = 0, 1, 2, 3, 4
    return codes


CODES = _class_codes()


def text_view(text: str | None) -> np.ndarray:
    """Pairs of character classes, and how long, varied and repetitive the words and lines are."""
    view = np.zeros(TEXT_SIZE, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) > 1:
        codes = CODES[data].astype(np.int64)
        pairs = np.bincount(codes[:-1] * CLASSES + codes[1:], minlength=CLASSES * CLASSES)
        view[: CLASSES * CLASSES] = np.sqrt(pairs / pairs.sum())
        words, lines = WORD.findall(text), text.split("\n")
        lengths = np.array([len(w) for w in words] or [0])
        view[-6:] = (
            np.log1p(len(data)) / 10, len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines),
            lengths.mean() / 10, min(lengths.std() / 10, 5), np.log1p(len(lines)) / 10)
    return view


def metadata_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed language, source and their pair, and the magnitude of the length; nulls are values."""
    view = np.zeros(META_SIZE, np.float32)
    for field in (f"lang={lang}", f"source={source}", f"pair={lang}|{source}"):
        view[crc32(field.encode("utf-8", "surrogatepass")) % 64] += 1
    view[64 + (0 if n_chars is None or n_chars < 1 else min(23, 1 + int(n_chars).bit_length()))] = 1
    return view


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-4, steps: int = 200, rate: float = 0.3) -> np.ndarray:
    """Weights (last: bias) of a class-balanced logistic regression, by full-batch Adam."""
    x = np.hstack((x, np.ones((len(x), 1), x.dtype)))
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        grad = x.T @ ((_sigmoid(x @ w) - y) * weight) + decay * w
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w


def odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _steepness(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and offset that turn a view's log-odds into calibrated ones; the natural class shares count."""
    a, b = 1.0, 0.0
    for _ in range(100):  # Newton steps with a little decay
        p = _sigmoid(a * z + b)
        r, s = p - y, np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(r * z).sum() + 0.01 * a, r.sum() + 0.01 * b])
        curve = np.array([[(s * z * z).sum() + 0.01, (s * z).sum()], [(s * z).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(curve, grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return np.array([max(a, 0.0), b])


def co_train(views: list[np.ndarray], y: np.ndarray, fold: np.ndarray) -> dict[str, np.ndarray]:
    """Train both views; ``y`` is 0, 1 or -1 (unlabelled), ``fold`` marks rows that only calibrate.

    In every round each view labels the unlabelled rows it is surest of (at most
    ``SHARE`` of them per class, with confidence ``SURE``); they join the other
    view's training set.  Afterwards each view is calibrated on the held rows and
    the calibrated log-odds are combined by one more fit on the same rows.
    """
    known, open_rows, held = (y >= 0) & ~fold, y < 0, (y >= 0) & fold
    labels = [np.where(known, y, -1) for _ in views]
    weights = []
    for _ in range(ROUNDS + 1):
        weights = [logistic(view[own >= 0], own[own >= 0]) for view, own in zip(views, labels, strict=True)]
        most = int(SHARE * open_rows.sum())
        for number, view in enumerate(views):
            other = labels[1 - number]
            p = _sigmoid(odds(view, weights[number]))
            for kind, sure in ((1, p), (0, 1 - p)):
                free = np.flatnonzero(open_rows & (other < 0) & (sure >= SURE))
                other[free[np.argsort(-sure[free], kind="stable")[:most]]] = kind
    rows = held if len(set(y[held].tolist())) == 2 else known
    z = [odds(view[rows], w) for view, w in zip(views, weights, strict=True)]
    scale = [_steepness(own, y[rows]) for own in z]
    both = np.stack([a * own + b for own, (a, b) in zip(z, scale, strict=True)], 1)
    share = float(np.clip(y[rows].mean(), 0.01, 0.99))
    mix = logistic(both, y[rows], decay=1e-3, steps=100, rate=0.1)
    mix[-1] += np.log(share / (1 - share))  # the fit is balanced; scores keep the natural shares
    return {"text": weights[0], "meta": weights[1], "scale": np.concatenate(scale), "mix": mix}


def _constant(share: float) -> dict[str, np.ndarray]:
    z = float(np.log(share / (1 - share)))
    return {"text": np.zeros(TEXT_SIZE + 1), "meta": np.zeros(META_SIZE + 1), "scale": np.array([1.0, 0, 1, 0]), "mix": np.array([0.0, 0, z])}


FIELDS = ("text", "meta", "scale", "mix")


def learn(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray]:
    """Fit on documents (doc_id, text, lang, source, n_chars) and labels (doc_id, quality).

    Rows are drawn by a hash of the id at rates that expect ``ROWS`` labelled and
    ``ROWS`` unlabelled ones; their views, not their texts, reach the one task
    that trains.  Contradicting labels count as 0.  With labels of one class only
    every score is that class's share.
    """
    wanted = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    n_labels, n_docs = wanted.count(), docs.count()
    draw = F.pmod(F.xxhash64(F.lit(3), F.col("doc_id")), F.lit(1_000_000)) / 1_000_000
    rates = min(1.0, ROWS / max(1, n_labels)), min(1.0, ROWS / max(1, n_docs - n_labels))
    views = docs.where(F.col("doc_id").isNotNull() & (draw < max(rates)))

    def make():
        def run(batch):
            columns = [batch.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars")]
            return (
                [text_view(t).tobytes() for t in columns[0]],
                [metadata_view(*row).tobytes() for row in zip(*columns[1:], strict=True)])

        return run

    # the left join keeps what is drawn of the documents; draws agree on both sides
    sample = (
        with_arrays(views, {"text_view": "binary", "meta_view": "binary"}, make, dropped=("text", "lang", "source", "n_chars"))
        .join(wanted.where(draw < max(rates)), "doc_id", "left")
        .withColumn("y", F.coalesce("y", F.lit(-1)))
        .where(draw < F.when(F.col("y") >= 0, rates[0]).otherwise(rates[1]))
    )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text_view"])
        y = rows["y"].to_numpy()
        fold = np.array([crc32(f"fold{i}".encode()) % CALIBRATE == 0 for i in rows["doc_id"]])
        seen = y[y >= 0]
        if len(set(y[(y >= 0) & ~fold].tolist())) < 2:
            model = _constant(float(np.clip(seen.mean() if len(seen) else 0.5, 0.01, 0.99)))
        else:
            stacked = [np.stack([np.frombuffer(v, np.float32) for v in rows[c]]) for c in ("text_view", "meta_view")]
            model = co_train(stacked, y, fold)
        return pd.DataFrame({f: [np.asarray(model[f], np.float64).tobytes()] for f in FIELDS})

    row = sample.groupBy().applyInPandas(fit, ", ".join(f"{f} binary" for f in FIELDS)).first()
    return {f: np.frombuffer(row[f], np.float64) for f in FIELDS} if row else _constant(0.5)


def score(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """Add ``text_score``, ``meta_score`` (calibrated), ``score`` and ``quality_pred``; nothing is shuffled.

    Null texts are empty, other nulls are values of their own, repeated rows score alike.
    """

    def make():
        def run(batch):
            texts, langs, sources, sizes = (batch.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))
            a, b, c, d = model["scale"]
            left = a * odds(np.stack([text_view(t) for t in texts]), model["text"]) + b
            right = c * odds(np.stack([metadata_view(*row) for row in zip(langs, sources, sizes, strict=True)]), model["meta"]) + d
            total = _sigmoid(odds(np.stack((left, right), 1), model["mix"]))
            return _sigmoid(left), _sigmoid(right), total, [int(p >= THRESHOLD) for p in total]

        def whole(batch):
            return run(batch) if batch.num_rows else ([], [], [], [])

        return whole

    return with_arrays(docs, {"text_score": "double", "meta_score": "double", "score": "double", "quality_pred": "int"}, make)


@query()
def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).drop("text", "lang", "source", "n_chars")
