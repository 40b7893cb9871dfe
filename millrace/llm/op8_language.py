"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import id_hash, query, release, table, with_arrays
from .hashing import BASE, BASE_INVERSE, mixed, powers

WORD = re.compile(r"[^\W\d_]+")  # may hold other signs that count as word characters, such as fractions
LONGEST, SHORTEST = 5, 1  # lengths of n-grams
ROWS_PER_LANGUAGE = 2500  # expected number of labelled rows that are learned from
SAMPLE_ROWS = 100_000  # and of those of all languages together; the model has only their terms
SENT_LANGUAGES = 100_000  # counts of so many languages go to every task; more are joined by a shuffle
REMEMBERED = 1 << 20  # numbers (words times languages) a task keeps as evidence of words
AT_ONCE = 50_000  # words of texts worked on together
_GOLD = 0x9E3779B97F4A7C15
_SALTS = [np.uint64(_GOLD * (size + 1) % 2**64) for size in range(LONGEST + 1)]


def words_of(text: str) -> list[str]:
    """Runs of word characters, without digits, that hold a letter."""
    return [word for word in WORD.findall(text.lower()) if word.isalpha() or any(map(str.isalpha, word))]


class Spelling:
    """Hashes of words and of their character n-grams, all words at once."""

    def __init__(self, words: list[str]):
        text = "<" + "><".join(words) + ">" if words else ""
        codes = mixed(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1))
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(self.lengths + 2) - self.lengths - 1  # the first letter of each word
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers(BASE, len(codes)), out=self.sums[1:])

    def _at(self, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        total = (self.sums[ends] - self.sums[starts]) * powers(BASE_INVERSE, len(self.sums))[starts]
        return mixed(mixed(total) ^ _SALTS[size])

    def whole(self) -> np.ndarray:
        return self._at(self.first, self.first + self.lengths, 0)

    def grams(self, chosen: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams of the chosen words, and the place in ``chosen`` each belongs to.

        Longer ones may take in the border before or after the word; a border alone is no evidence.
        """
        start = self.first[chosen] - (size > 1)
        count = np.maximum(0, self.lengths[chosen] + 2 * (size > 1) - size + 1)
        owner = np.repeat(np.arange(len(chosen)), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
        return self._at(at, at + size, size), owner


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            words.setdefault(lang, Counter()).update(words_of(text))
        for lang, counts in words.items():
            spelling, times = Spelling(list(counts)), np.fromiter(counts.values(), np.int64, len(counts))
            every = np.arange(len(counts))
            for size in range(LONGEST + 1):
                keys, owner = (spelling.whole(), every) if not size else spelling.grams(every, size)
                found, own = np.unique(keys, return_inverse=True)
                totals = np.zeros(len(found), np.int64)
                np.add.at(totals, own, times[owner])
                yield pd.DataFrame({"lang": lang, "size": np.int32(size), "term": found.view(np.int64), "n": totals})
    release()


def learn(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on rows (doc_id, text, lang); rows without text or lang teach nothing.

    Rows are drawn by a hash of id and text at a rate that expects at most
    ``rows_per_language`` of a language and ``sample_rows`` altogether.  All their words and n-grams
    are kept, with their counts in every language.  An empty table gives a model without languages.
    """
    labelled = labelled.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    totals = labelled.groupBy("lang").agg(F.count("*").alias("__rows"))
    languages = max(1, totals.count())
    totals = F.broadcast(totals) if languages <= SENT_LANGUAGES else totals  # no text moves
    rate = F.least(F.lit(1.0), F.lit(min(rows_per_language, sample_rows / languages)) / F.col("__rows"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    counts = (
        labelled.join(totals, "lang").where(draw < rate).select("lang", "text")
        .mapInPandas(_count, "lang string, size int, term long, n long").groupBy("lang", "size", "term").agg(F.sum("n").alias("n"))
    )
    rows = counts.toArrow()  # the terms of the sampled rows
    return Model.of(*(rows.column(name).to_numpy(zero_copy_only=False) for name in ("lang", "size", "term", "n")))


class Model:
    """Counts of terms by language: ``langs[at]`` and ``counts[at]`` for at in ``starts[i]`` to ``starts[i + 1]`` belong to ``terms[i]``.

    ``scales[size]`` has what the counts of words (size 0) and n-grams are divided by in each language.
    A term's log frequency is log((n + 0.5) / scale).
    """

    def __init__(self, languages: list[str], terms: np.ndarray, starts: np.ndarray, langs: np.ndarray, counts: np.ndarray, scales: np.ndarray):
        self.languages, self.terms, self.starts, self.langs, self.counts, self.scales = languages, terms, starts, langs, counts, scales

    def parts(self) -> tuple:
        return self.languages, self.terms, self.starts, self.langs, self.counts, self.scales

    @classmethod
    def of(cls, lang: np.ndarray, size: np.ndarray, term: np.ndarray, n: np.ndarray) -> Model:
        languages = sorted(set(lang.tolist()))
        place = {name: i for i, name in enumerate(languages)}
        own = np.fromiter((place[name] for name in lang.tolist()), np.int32, len(lang))
        scales = np.ones((LONGEST + 1, len(languages)))
        total, distinct = np.zeros_like(scales), np.zeros_like(scales)
        np.add.at(total, (size, own), n)
        np.add.at(distinct, (size, own), 1)
        scales = np.where(distinct > 0, total + 0.5 * distinct, 1.0)
        order = np.lexsort((own, term.view(np.uint64)))
        terms, starts = np.unique(term.view(np.uint64)[order], return_index=True)
        return cls(languages, terms, np.append(starts, len(order)), own[order], n[order].astype(np.float32), scales)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each term, -1 for unknown ones."""
        if not len(self.terms):
            return np.full(len(keys), -1)
        order = np.argsort(keys)  # in order, neighbours are looked up in the same part of memory
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(self.terms, keys[order])
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == keys, at, -1)

    def _evidence(self, found: np.ndarray, owner: np.ndarray, words: int, size: int) -> np.ndarray:
        """For each of ``words`` words the mean log frequencies of its terms ``found``; each has one at least."""
        weights = 1.0 / np.bincount(owner, minlength=words)
        count = self.starts[found + 1] - self.starts[found]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.starts[found], count)
        word = np.repeat(owner, count)
        width = len(self.languages)
        more = np.bincount(word * width + self.langs[at], np.log(2.0 * self.counts[at] + 1.0) * weights[word], words * width)
        return np.log(0.5 / self.scales[size]) + more.reshape(words, width)

    def evidence(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log frequencies of the words by language, and which words have any.

        Those of the word, or of its longest n-grams of which one is known, in the mean, if the word is unseen.
        """
        spelling = Spelling(words)
        values, known = np.zeros((len(words), len(self.languages))), np.zeros(len(words), bool)
        if not self.languages or not words:
            return values, known
        left = np.arange(len(words))
        for size in [0, *range(LONGEST, SHORTEST - 1, -1)]:
            keys, owner = (spelling.whole()[left], np.arange(len(left))) if not size else spelling.grams(left, size)
            found = self._find(keys)
            owner, found = owner[found >= 0], found[found >= 0]
            has, own = np.unique(owner, return_inverse=True)
            if len(has):
                values[left[has]] = self._evidence(found, own, len(has), size)
                known[left[has]] = True
                left = np.delete(left, has)
        return values, known


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) to every row, in place of columns of these names; nothing is shuffled.

    ``und`` with score 0 where the text is null or has no letter, or where
    nothing was learned.  A text whose letters are all unknown gets the first
    learned language with the score of a blind guess.  Ties go to the language
    that sorts first.  The score is the probability of the language given the words.
    """
    # bounded by SAMPLE_ROWS: some 20 bytes for each term and language of the rows learned from
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def make():
        own = Model(*shared.value)
        width = max(1, len(own.languages))
        most = max(1, REMEMBERED // width)
        at_once = min(AT_ONCE, most)
        table = np.zeros((1, width))  # row 0: no evidence
        known: dict[str, int] = {}

        def learn_words(words: set[str]) -> None:
            nonlocal table, known
            new = sorted(words - known.keys())
            if len(known) + len(new) > most:
                known, table = {}, np.zeros((1, width))
                new = sorted(words)
            if new:
                values, has = own.evidence(new)
                rows = len(table) - 1 + np.cumsum(has)
                table = np.concatenate((table, values[has]))
                known.update(zip(new, np.where(has, rows, 0).tolist(), strict=True))

        def run(batch):
            found, scores = [], []
            held: list[tuple[list[str], bool]] = []  # parts of texts, and whether the text ends there
            total = np.zeros(width)

            def flush() -> None:
                nonlocal total
                learn_words({word for words, _ in held for word in words})
                for words, last in held:
                    total += table[[known[word] for word in words]].sum(axis=0)
                    if last:
                        odds = np.exp(total - total.max())
                        best = int(total.argmax())
                        found.append(own.languages[best])
                        scores.append(float(odds[best] / odds.sum()))
                        total = np.zeros(width)
                held.clear()

            size = 0
            for value in batch.column(text).to_pylist():
                words = words_of(value) if value and own.languages else []
                if not words:
                    flush()
                    found.append("und")
                    scores.append(0.0)
                for start in range(0, len(words), at_once):
                    held.append((words[start : start + at_once], start + at_once >= len(words)))
                    size += len(held[-1][0])
                    if size > at_once:
                        flush()
                        size = 0
            flush()
            return found, scores

        return run

    return with_arrays(docs, {"lang_pred": "string", "score": "double"}, make)


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) is not divisible by 5 and identify all rows.

    Adds ``held_out`` (not learned from), ``lang_pred`` and ``score``.
    """
    held_out = id_hash(F.col("doc_id"), 5) == 0
    model = learn(docs.where(~held_out))
    return identify(docs.withColumn("held_out", held_out), model)


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_hash(F.col("doc_id"), 5) == 0
    model = learn(docs.where(~held_out))
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")
