import numpy as np
from pyspark.sql import functions as F

from millrace.llm import op3_toxicity as t


def corpus(n=240):
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("aeioukmnrst"), 5)) for _ in range(300)]
    bad = ["zqrudfy", "zqrudfa", "zqrudfo"]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, 60))
        toxic = i % 3 == 0
        if toxic:
            words[int(rng.integers(60))] = bad[i % 2]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels, plain


def test_unseen_misspelling_shares_subwords(spark, docs_of):
    rows, labels, plain = corpus()
    table = spark.createDataFrame(labels + [(999, None), (None, 1)], "doc_id long, toxic int")
    odds, bias = t.learn(docs_of(rows), table)
    tests = [(1, " ".join(plain[:50])), (2, " ".join([*plain[:30], "zqrudfi", "zqrudfi", *plain[30:60]])), (3, None), (4, ""), (5, "..."), (6, "word " * 40_000)]
    found = {r["doc_id"]: r for r in t.score(docs_of(tests), odds, bias).collect()}
    assert found[1]["predicted"] == 0 and found[2]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_one_class_and_no_labels(spark, docs_of):
    rows = docs_of([(1, "a b"), (2, None)])
    for labels in ([], [(1, 0)]):
        odds, bias = t.learn(rows, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [r["predicted"] for r in t.score(rows, odds, bias).collect()] == [0, 0]
    assert t.score(docs_of([]), odds, bias).count() == 0


def slow_score(text, odds, bias, whole):
    """The definition word by word: means over subwords, over the words of a window, and the windows together."""
    words = t.WORD.findall((text or "").lower())
    value = lambda word: float(np.mean([odds[b] for b in t.subwords(word)]))
    windows = [words] if whole else [words[i : i + t.WINDOW] for i in range(0, max(1, len(words) - t.WINDOW + t.STEP), t.STEP)]
    clean = 1.0
    for window in windows:
        z = t.WINDOW * np.mean([value(w) for w in window]) + bias if window else bias
        clean *= 1 / (1 + np.exp(z))
    return 1 - clean


def test_scores_against_definition(spark, docs_of):
    rng = np.random.default_rng(3)
    odds, bias = rng.normal(0, 1, t.BUCKETS), -2.0
    stock = ["ab", "été", "x1", "straße", "WORD", "Ⅷ", "longerword"]
    texts = [" ".join(rng.choice(stock, n)) for n in (1, 2, 7, 8, 9, 11, 12, 13, 40)] + [None, "", "..", "_"]
    for whole in (False, True):
        found = {r["doc_id"]: r["score"] for r in t.score(docs_of(list(enumerate(texts))), odds, bias, whole=whole).collect()}
        assert all(abs(found[i] - slow_score(text, odds, bias, whole)) < 1e-9 for i, text in enumerate(texts))


def test_held_out_documents(spark):
    """On 10 000 documents, learned from few labels: windows find more than the average over the whole text (README)."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    held_out = t.id_hash(F.col("doc_id"), 3) == 1
    caught, flagged = {}, {}
    for whole in (False, True):
        model = t.learn(docs.where(~held_out), labels.where(~held_out), whole)
        found = t.score(docs.where(held_out).join(labels, "doc_id").select("doc_id", "text", "toxic"), *model, whole=whole).collect()
        caught[whole], flagged[whole] = (np.mean([r["predicted"] for r in found if r["toxic"] == kind]) for kind in (1, 0))
    assert caught[False] > 0.65 and flagged[False] < 0.02
    assert caught[False] > caught[True] and flagged[False] <= flagged[True]
