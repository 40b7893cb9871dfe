import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import bitmaps
from millrace.llm import op11_phrases as p


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, kept, least):
    """Every phrase of every language counted, cut and compared with all longer ones."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und" if lang != "" else "", Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered(text or "")):
            words = tuple(w for w in re.split(r"[ \t]+", piece) if w)
            totals[lang if lang is not None else "und"] += len(words)
            for size in range(1, 5):
                own.update(words[i : i + size] for i in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        candidates = {q: a for q, a in f.items() if len(q) > 1 and a >= least}
        left = []
        for q, a in candidates.items():
            if any(len(o) > len(q) and 100 * b >= 80 * a and any(o[i : i + len(q)] == q for i in range(len(o) - len(q) + 1)) for o, b in candidates.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[q[:k]] + f[q[k:]]), k, f[q[:k]], f[q[k:]]) for k in range(1, len(q)))  # noqa: E741
            left.append((-score, -a, " ".join(q).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(left)[:kept], 1):  # noqa: E741
            found.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def ours(df, **options):
    return sorted(tuple(r) for r in p.collocations(df, **options).collect())


def sample(rng, count):
    letters = ["a", "B", "é", "É", "dd", "E", "e", "f's", "(g", "hh", "ü", "x" * 40]
    fixed = ["new york city hall", "New York", "a a a a a", "one\ttwo  three", "de facto"]

    def text():
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(letters) for _ in range(rng.randrange(30))]
        return "".join(part + rng.choice((" ", " ", " ", "\t", ". ", ",", "\n", "!?", "  ")) for part in parts)

    return [(rng.choice(("en", "en", "en", "de", None, "")), text()) for _ in range(count)]


@pytest.mark.parametrize("kept,frontier", [(2000, 4), (6, 1), (25, 1)])
def test_against_brute_force(spark, kept, frontier):
    rows = sample(random.Random(kept), 160) + [("en", None), ("fr", ""), ("fr", "too few words"), (None, None)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert ours(df, kept=kept, least=4, frontier=frontier) == brute(rows, kept, 4)


def test_more_waves_and_missing_rests(spark, monkeypatch):
    """Only the best pair is open at first, and every filter lets all through."""
    rng = random.Random(11)
    rows = sample(rng, 120) + [("en", "p q r s. q r s. r s. s") for _ in range(9)]
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(bitmaps, "MOST_BITS", 6)
    monkeypatch.setattr(bitmaps, "LEAST_BITS", 6)
    assert ours(df, kept=3, least=3, frontier=1) == brute(rows, 3, 3)


def test_und_and_null_are_one_language(spark):
    rows = [(None, "w v")] * 3 + [("und", "w v. w")] * 2
    assert ours(spark.createDataFrame(rows, "lang string, text string"), least=2) == [("und", 1, "w v", 5, 7, 5, 12, 833333)]


def test_long_texts_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(p, "PILE", 50)
    rng = random.Random(2)
    rows = [("en", " ".join(rng.choice(("aa", "b", "Cc", "d.", "e\n")) for _ in range(3000))), ("en", " ".join(rng.choice("ab") for _ in range(2000)))]
    assert ours(spark.createDataFrame(rows, "lang string, text string"), least=20) == brute(rows, 2000, 20)


def test_blocks_change_nothing(monkeypatch):
    text = "".join(random.Random(1).choice(("word ", "two. ", "é", "\n", "x" * 30, " ")) for _ in range(2000)).encode()
    whole = p.words_of(text)
    monkeypatch.setattr(p, "BLOCK", 64)
    parts = [p.words_of(block) for block in p._blocks(text)]
    assert np.array_equal(np.concatenate([x[0] for x in parts]), whole[0])
    new = np.concatenate([np.diff(x[1], prepend=-1) != 0 for x in parts if len(x[0])])
    assert np.array_equal(new, np.diff(whole[1], prepend=-1) != 0)


def test_large_counts_stay_exact(spark):
    rows = spark.createDataFrame([(4_000_000_000_000, 4_000_000_000_001, 4_000_000_000_003)], "a long, l long, r long")
    from pyspark.sql import functions as F

    got = rows.select(p._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()["s"]
    assert got == 2_000_000 * 4_000_000_000_000 // 8_000_000_000_004
    big = spark.range(1).select(*[F.lit(9_000_000_000_000_000_000).alias(c) for c in "alr"])
    assert big.select(p._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()["s"] == 1_000_000


def test_nothing_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert p.op11_phrases(spark, str(tmp_path)).collect() == []
    df = spark.createDataFrame([("en", "u v", 1, 2, "x")] * 3, "lang string, text string, a int, n int, w1 string")
    assert ours(df, least=3) == [("en", 1, "u v", 3, 3, 3, 6, 1_000_000)]
