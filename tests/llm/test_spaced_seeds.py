import random
from itertools import combinations

import numpy as np

from millrace.llm import op9_spaced_seeds as d


def test_longest_overlap_against_all_stretches():
    rng = random.Random(4)
    for _ in range(200):
        equal = np.array([rng.random() < 0.7 for _ in range(rng.randint(1, 25))])
        best = 0
        for i in range(len(equal)):
            for j in range(i + 1, len(equal) + 1):
                if equal[i:j].sum() * 1000 >= 800 * (j - i):
                    best = max(best, j - i)
        start, length = d.longest_overlap(equal, 0.8)
        assert length == best and equal[start : start + length].sum() * 1000 >= 800 * length


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n)]


def test_planted_passages(spark, docs_of):
    rng = random.Random(9)
    items = [words(rng, n) for n in (40, 40, 200, 9, 5)]
    docs, expected = [], {}
    for doc_id in range(60):
        body = words(rng, 300)
        item = doc_id % 6
        if item < 5:
            passage = list(items[item])
            if item == 1:  # every seventh word is replaced
                passage[3::7] = words(rng, len(passage[3::7]))
            body[100:100] = passage
            expected[doc_id] = item
        docs.append((doc_id, " ".join(body).replace("a", "A") + ".", "l", "s"))
    docs += [(100, None), (101, ""), (None, " ".join(items[0])), docs[0], (102, "word " * 30_000), (None, " ".join(words(rng, 50)))]
    expected[None] = 0  # rows without an id are searched too
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(7, None), (8, "")], "item_id long, text string")
    found = d.contaminated(docs_of(docs), benchmark).collect()
    assert {r["doc_id"]: r["item_id"] for r in found} == expected and len(found) == len(expected)
    for r in found:
        assert r["n_equal"] >= 0.8 * r["n_tokens"] and r["n_tokens"] >= min(13, len(items[r["item_id"]]))
        if r["item_id"] != 1:
            assert r["n_tokens"] >= len(items[r["item_id"]]) and r["n_equal"] >= len(items[r["item_id"]])


def test_empty_tables(spark, docs_of):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated(docs_of([(1, "a b c d e f g h i j")]), benchmark).count() == 0
    assert d.contaminated(docs_of([]), spark.createDataFrame([(1, "a b c d e f g h i")], "item_id long, text string")).count() == 0


def fits(mask, n, gone):
    return any(not any(mask[g - at] == "1" for g in gone if at <= g < at + len(mask)) for at in range(n - len(mask) + 1))


def test_masks_fit_whatever_differs():
    for n, k in ((13, 2), (15, 3), (20, 4), (25, 5)):
        assert all(any(fits(m, n, gone) for m in d.MASKS) for gone in combinations(range(n), k))
    for n in range(1, 13):
        assert all(any(fits(m, n, gone) for m in d.whole_masks(n)) for gone in combinations(range(n), n // 5))


def test_substitutions_against_brute_force(spark, docs_of):
    rng = random.Random(12)
    items = [words(rng, n) for n in [*range(1, 26), 30, 40]]
    docs = []
    for doc_id in range(81):
        item = items[doc_id % len(items)]
        passage, share = list(item), rng.choice([0.1, 0.15, 0.2, 0.2, 0.25])
        for at in rng.sample(range(len(passage)), int(len(passage) * share)):
            passage[at] = words(rng, 1)[0]
        body = words(rng, 80)
        body[30:30] = passage
        docs.append((doc_id, " ".join(body)))
    expected = set()
    for doc_id, text in docs:
        left = d.tokens_of(text)
        for item_id, item in enumerate(items):
            right = d.tokens_of(" ".join(item))
            for shift in range(1 - len(right), len(left)):
                low, high = max(0, -shift), min(len(right), len(left) - shift)
                if d.longest_overlap(left[low + shift : high + shift] == right[low:high], d.SAME)[1] >= min(d.LEAST, len(right)):
                    expected.add((doc_id, item_id))
                    break
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = d.contaminated(docs_of(docs), benchmark, shortest=1).collect()
    assert len(expected) > 60 and sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(expected)
    kept = d.without_overlaps(docs_of(docs), benchmark).collect()
    assert {r["doc_id"] for r in kept} == set(range(81)) - {doc_id for doc_id, _ in expected}


def test_strides():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(0, 40)
        hashes = np.array([rng.choice((1, 1, 1, 2, 9)) for _ in range(n)], np.uint64)
        places = np.array(sorted(rng.sample(range(80), n)), np.int64)
        found = [(int(h), int(at + i * step)) for h, at, step, times in zip(*d.strides(hashes, places), strict=True) for i in range(times)]
        assert sorted(found) == sorted(zip(hashes.tolist(), places.tolist(), strict=True))
    assert [x.tolist() for x in d.strides(np.full(1000, 5, np.uint64), np.arange(1000) * 3)] == [[5], [0], [3], [1000]]


def test_repeated_tokens_stay_small(spark, docs_of):
    """A document of one token and an item of the same, and patterns of different periods."""
    items = [(0, "la " * 200), (1, "la li " * 40), (2, "la la li " * 30)]
    docs = [(0, "la " * 20_000), (1, "la li " * 500), (2, "li la la " * 500), (3, "lo " * 500)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["n_tokens"] for r in d.contaminated(docs_of(docs), benchmark).collect()}
    for doc_id, text in docs:
        left = d.tokens_of(text)[:1200]
        for item_id, item in items:
            right = d.tokens_of(item)
            best = max((d.longest_overlap(left[max(0, s) : len(right) + s][: min(len(right) - max(0, -s), len(left) - max(0, s))] == right[max(0, -s) : min(len(right), len(left) - s)], 0.8)[1] for s in range(1 - len(right), len(left))), default=0)
            assert ((doc_id, item_id) in found) == (best >= 13)


def test_rows_go_by_their_own_text(spark, docs_of):
    rng = random.Random(3)
    item, clean = " ".join(words(rng, 30)), " ".join(words(rng, 30))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_of([(1, item), (1, clean), (None, item), (None, clean), (2, item), (2, item), (3, None)]).withColumnRenamed("lang", "text_key")
    kept = [(r["doc_id"], r["text"]) for r in d.without_overlaps(docs, benchmark).collect()]
    assert sorted(kept, key=repr) == sorted([(1, clean), (None, clean), (3, None)], key=repr)
