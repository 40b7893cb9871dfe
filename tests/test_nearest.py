import hashlib

import numpy as np
import pytest

from millrace.operators import nearest as N


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(400, 8)).round(2)
    rows[200:230] = rows[0]  # equal vectors: ties go to the smaller id
    queries = rng.normal(size=(23, 8)).round(2)
    queries[3] = 0
    r = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)] + [(999, None)], "id bigint, v array<double>")
    q = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(queries)], "qid string, w array<double>")
    return rows, queries, r.repartition(5), q


def brute(rows, queries, similarity, k):
    products = rows @ queries.T
    if similarity == "l2":
        scores = -((rows[:, None, :] - queries[None, :, :]) ** 2).sum(-1)
    elif similarity == "cosine":
        lengths = np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(queries, axis=1)[None, :]
        scores = np.divide(products, lengths, out=np.zeros_like(products), where=lengths > 0)
    else:
        scores = products
    found = {}
    for q in range(queries.shape[0]):
        order = sorted(range(len(rows)), key=lambda i: (-round(scores[i, q], 9), i))[:k]
        found[f"q{q}"] = order
    return found


@pytest.mark.parametrize("similarity", ["cosine", "dot_product", "max_inner_product", "l2"])
@pytest.mark.parametrize("most", [N.MAX_SENT_BYTES, 0])
def test_best_rows_match_brute_force(vectors, similarity, most, monkeypatch):
    rows, queries, r, q = vectors
    monkeypatch.setattr(N, "ROWS_PER_BLOCK", 60)
    monkeypatch.setattr(N, "QUERIES_PER_BLOCK", 7)
    found = {}
    for x in N.best_rows(r, q, "id", "qid", "v", "w", similarity, 4, max_sent_bytes=most).orderBy("qid", "rank").collect():
        found.setdefault(x.qid, []).append(x.id)
    assert found == brute(rows, queries, similarity, 4)


@pytest.mark.parametrize("most", [N.MAX_SENT_BYTES, 0])
def test_jaccard(spark, most):
    docs = [(1, ["a", "b", "c", "a"]), (2, ["a", "b"]), (3, ["z"]), (4, []), (5, ["b", "a"])]
    asked = [(10, ["a", "b"]), (11, ["z", "y"]), (12, [])]
    d = spark.createDataFrame(docs, "id int, t array<string>")
    q = spark.createDataFrame(asked, "qid int, u array<string>")
    found = N.best_rows(d, q, "id", "qid", "t", "u", "jaccard", 3, max_sent_bytes=most).orderBy("qid", "rank").collect()
    assert [(r.qid, r.id, round(r.score, 6)) for r in found] == [
        (10, 2, 1.0), (10, 5, 1.0), (10, 1, 0.666667), (11, 3, 0.5), (11, 1, 0.0), (11, 2, 0.0),
        (12, 1, 0.0), (12, 2, 0.0), (12, 3, 0.0),
    ]


def test_nearest_rows_and_empty_queries(vectors):
    rows, queries, r, q = vectors
    found = {x.qid: x.id for x in N.nearest_rows(r, q, "id", "qid", "v", "w").collect()}
    assert found == {k: v[0] for k, v in brute(rows, queries, "l2", 1).items()}
    assert N.nearest_rows(r, q.where("qid = 'none'"), "id", "qid", "v", "w").count() == 0


def lloyd(points, k, steps):
    """Centers after some steps from the k points whose hashed ids are least."""
    start = sorted(points, key=lambda p: hashlib.md5(f"42:{p[0]}".encode()).hexdigest())[:k]
    x, centers = np.array([v for _, v in points]), np.array([v for _, v in start])
    for _ in range(steps):
        own = ((x[:, None] - centers[None]) ** 2).sum(-1).argmin(1)
        centers = np.array([x[own == c].mean(0) if (own == c).any() else centers[c] for c in range(k)])
    return x, centers


def test_diverse_rows_against_lloyd_steps(spark):
    rng = np.random.default_rng(4)
    points = [(i, rng.normal(0, 1, 3).tolist()) for i in range(200)]
    df = spark.createDataFrame([*points, (999, None)], "id int, v array<double>")
    x, centers = lloyd(points, 6, 4)
    nearest = ((x[:, None] - centers[None]) ** 2).sum(-1)
    found = {r.cluster: r.id for r in N.diverse_rows(df, "id", "v", k=6, iterations=4).collect()}
    assert found == dict(enumerate(nearest.argmin(0).tolist()))
    own = nearest.argmin(1)
    assigned = {r.cluster: r.id for r in N.diverse_rows(df, "id", "v", k=6, iterations=4, mode="assigned").collect()}
    assert assigned == {c: int(np.flatnonzero(own == c)[nearest[own == c, c].argmin()]) for c in range(6)}
    assert N.diverse_rows(df, "id", "v", k=6, distinct=True).count() == len(set(found.values()))
    assert N.diverse_rows(df.where("id < 0"), "id", "v", k=6).count() == 0


def test_nearest_at_small_and_offset_scale(spark):
    rows = spark.createDataFrame([(1, [2e-5]), (2, [1e-5]), (3, [0.0]), (4, [1e6]), (5, [1e6 + 1e-4]), (6, [1e6 + 3e-4])], "id int, v array<double>")
    asked = spark.createDataFrame([(1, [1e-9]), (2, [1e6 + 2.9e-4])], "qid int, w array<double>")
    assert {r.qid: r.id for r in N.nearest_rows(rows, asked, "id", "qid", "v", "w").collect()} == {1: 3, 2: 6}


@pytest.mark.parametrize("most", [N.MAX_SENT_BYTES, 0])
def test_nearest_when_queries_are_far_apart(spark, most):
    offsets = np.random.default_rng(8).permutation(np.linspace(1e-4, 1e-2, 2000))
    rows = spark.createDataFrame([(i, [2e6 + v]) for i, v in enumerate(offsets.tolist())], "id int, v array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [0.0]), (2, [2e6])], "qid int, w array<double>")
    found = N.best_rows(rows, asked, "id", "qid", "v", "w", "l2", 3, max_sent_bytes=most).orderBy("rank").collect()
    x = 2e6 + offsets
    for qid, at in ((1, 0.0), (2, 2e6)):
        # ranks are by 12 digits of the squared distance, ties by id
        true = sorted(range(2000), key=lambda i: (float(f"{(x[i] - at) ** 2:.11e}"), i))[:3]
        assert [r.id for r in found if r.qid == qid] == true


def test_unknown_similarity(vectors):
    with pytest.raises(ValueError):
        N.best_rows(vectors[2], vectors[3], "id", "qid", "v", "w", "euclid")


def test_few_scores_are_ranked(monkeypatch):
    """Only scores that may be among the best so far are rounded; the others go by one comparison."""
    rng, ranked = np.random.default_rng(3), []
    kept = N._significant

    def counted(digits):
        return lambda scores: ranked.append(scores.size) or kept(digits)(scores)

    monkeypatch.setattr(N, "_significant", counted)
    monkeypatch.setattr(N, "SCORES_AT_ONCE", 4000)
    monkeypatch.setattr(N, "QUERIES_AT_ONCE", 16)
    rows, queries = rng.normal(size=(5000, 6)), rng.normal(size=(40, 6))
    found = N._best_vectors(3, "cosine", ("q", "id", "score"))(list(range(40)), queries, iter([(list(range(5000)), list(rows))]))
    assert sum(ranked) < 0.05 * 5000 * 40
    scores = (rows / np.linalg.norm(rows, axis=1)[:, None]) @ (queries / np.linalg.norm(queries, axis=1)[:, None]).T
    assert [list(g["id"]) for _, g in found.groupby("q")] == [list(np.argsort(-scores[:, q])[:3]) for q in range(40)]
