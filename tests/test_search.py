import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import nearest as N
from millrace.operators import setsearch as S
from millrace.operators import vectorsearch as X
from millrace.session import work_path


def sets_of(seed, count, words=60):
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(words)]
    found = []
    for i in range(count):
        if found and rng.random() < 0.5:  # a variant, or a copy, of an earlier one
            own = list(rng.choice(found)[1] or ["w1"])
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(stock)
        else:
            own = [rng.choice(stock[: rng.choice((5, 60))]) for _ in range(rng.randrange(1, 25))]
        found.append((i * 3 % 1009, own))
    found += [(2000, []), (2001, None), (2002, ["only one"]), (2003, ["w1"] * 5)]
    return found + [(3000 + i, ["w2", "w3", "copy"]) for i in range(40)]  # many copies


def brute(rows, queries, k, least=None):
    found = {}
    for query, asked in queries:
        if asked is None:
            continue
        q = set(asked)
        scores = sorted((-(len(q & set(r)) / len(q | set(r)) if q | set(r) else 0.0), i) for i, r in rows if r is not None)
        found[query] = [(i, -s) for s, i in scores[:k] if least is None or -s >= least]
    return found


def grouped(df, query="q"):
    found = {}
    for r in df.orderBy(query, "rank").collect():
        found.setdefault(r[query], []).append((r["id"], r["score"]))
        assert r["rank"] == len(found[r[query]])
    return found


@pytest.mark.parametrize("k,first,part", [(1, 6, 20_000), (3, 1, 4), (50, 2, 7)])
def test_prefix_search_is_exact(spark, k, first, part):
    rows = sets_of(1, 150)
    queries = [(i, t) for i, t in sets_of(2, 30)[:33]] + [(5000, ["never seen"]), (5001, ["never seen", "w1", "w2"])]
    index = S.prefix_index(spark.createDataFrame(rows, "id long, t array<string>"), "id", "t", part)
    found = grouped(S.best_sets(index, spark.createDataFrame(queries, "q long, a array<string>"), "q", "a", "id", k, first))
    expected = brute(rows, queries, k)
    assert found.keys() == expected.keys()
    for query, best in expected.items():
        assert [i for i, _ in found[query]] == [i for i, _ in best], query
        assert np.allclose([s for _, s in found[query]], [s for _, s in best])


def test_prefix_index_lists_are_cut_and_hold_classes_once(spark):
    """A token of all rows: its list comes in parts, copies of a set are one entry, and equal results follow (above)."""
    rows = [(i, ["common", f"own{i % 500}"]) for i in range(2000)]
    index = S.prefix_index(spark.createDataFrame(rows, "id long, t array<string>"), "id", "t", 50)
    assert index.lists.count() == 1000 and index.sets.count() == 500
    parts = index.lists.where("token = 'common'").groupBy("part").count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 100


def test_tokens_are_not_shuffled_to_be_ordered(spark, monkeypatch):
    """The entries of the lists stay in the order of their sets, and with few or many queries the result is the same."""
    rows = sets_of(21, 120) + [(4000, ["w1", None, "é", "z" * 300]), (4001, [None])]
    queries = sets_of(22, 20)[:20] + [(6000, ["w1", None, "é"])]
    plans, stored = {}, S.staged
    monkeypatch.setattr(S, "staged", lambda df, label: plans.update({label: df._jdf.queryExecution().optimizedPlan().toString()}) or stored(df, label))
    index = S.prefix_index(spark.createDataFrame(rows, "id long, t array<string>"), "id", "t", 5)
    assert all("Aggregate" not in plan for label, plan in plans.items() if label not in ("sets", "token-counts"))
    asked = spark.createDataFrame(queries, "q long, a array<string>")
    sent = grouped(S.best_sets(index, asked, "q", "a", "id", 4))
    monkeypatch.setattr(S, "SENT", 0)
    assert grouped(S.best_sets(index, asked, "q", "a", "id", 4)) == sent
    assert [i for i, _ in sent[6000]][0] == 4000 and sent[6000][0][1] == 0.75


def test_prefix_search_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, t array<string>")
    some = spark.createDataFrame([(1, ["a"])], "q long, a array<string>")
    assert S.best_sets(S.prefix_index(empty, "id", "t"), some, "q", "a", "id").collect() == []
    index = S.prefix_index(some.withColumnsRenamed({"q": "id", "a": "t"}), "id", "t")
    assert S.best_sets(index, some.where("false"), "q", "a", "id").collect() == []


def test_few_candidates_are_compared(spark):
    """Of 3 000 sets that share frequent tokens few are compared with a query that has a near copy."""
    rng = random.Random(4)
    rows = [(i, [f"f{rng.randrange(20)}" for _ in range(20)] + [f"r{rng.randrange(3000)}" for _ in range(20)]) for i in range(3000)]
    index = S.prefix_index(spark.createDataFrame(rows, "id long, t array<string>"), "id", "t")
    asked = [(i, rows[i][1][:-1]) for i in range(0, 3000, 100)]
    tokens = spark.createDataFrame([(q, len(set(t)), at, token) for q, t in asked for at, token in enumerate(sorted(set(t), key=lambda w: (w[0] != "r", w)))], "query long, n int, at int, token string")
    pairs = S._candidates(index, tokens.withColumn("threshold", F.lit(0.9)).where(F.col("at") < S._prefix(F.col("n"), F.col("threshold")))).count()
    assert pairs < 5 * len(asked)


def test_band_shape():
    assert S.band_shape(1.0) == (1, 128) and S.band_shape(0.5)[1] >= 2
    bands, width = S.band_shape(0.8, 0.99)
    assert 1 - (1 - 0.8**width) ** bands >= 0.99
    with pytest.raises(ValueError):
        S.band_shape(0.001)


def recall(found, expected):
    wanted = [(q, i) for q, best in expected.items() for i, _ in best]
    return sum(i in {j for j, _ in found.get(q, [])} for q, i in wanted) / len(wanted)


def test_band_recall_and_repeated_batches(spark):
    rows = [(i, t) for i, t in sets_of(7, 400, 2000)]
    queries = rows[::5]
    index = S.BandIndex(spark, work_path(spark, "bands"), 0.5)
    df = spark.createDataFrame(rows, "id long, t array<string>").repartition(4)
    index.add(df.where("id % 2 = 0"), "id", "t", "a")
    once = index.search(spark.createDataFrame(queries, "q long, a array<string>"), "q", "a", "id", 1000)
    assert all(r["id"] % 2 == 0 for r in once.collect())
    for _ in range(2):  # the second time changes nothing
        index.add(df.where("id % 2 = 1"), "id", "t", "b")
        result = index.search(spark.createDataFrame(queries, "q long, a array<string>"), "q", "a", "id", 1000)
        found, expected = grouped(result), brute(rows, queries, 1000, 0.5)
        assert recall(found, expected) >= 0.97  # 0.99 at the least similarity, more above
        scores = {(q, i): s for q, best in expected.items() for i, s in best}
        assert all(abs(scores[q, i] - s) < 1e-12 for q, best in found.items() for i, s in best)
    assert result.agg(F.max("probed")).first()[0] < 400
    assert index.batches() == ["a", "b"]


def test_pairs_that_meet_by_chance_are_not_fetched(spark, monkeypatch):
    """Sets of which a tenth is shared meet in bands by chance; only the pairs that may be half alike move with their tokens, and all met ones are counted."""
    rng, seen = random.Random(11), []
    rows = [(i, [f"w{rng.randrange(110)}" for _ in range(20)]) for i in range(600)]
    rows += [(600 + i, rows[i][1][:-2] + [f"v{i}"]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    index = S.BandIndex(spark, work_path(spark, "bands"), 0.5)
    index.add(df.where("id % 2 = 0"), "id", "t", "a")
    index.add(df, "id", "t", "b")  # half of the classes twice
    verified = S._verified
    monkeypatch.setattr(S, "_verified", lambda pairs, queries, sets: seen.append(pairs.distinct().count()) or verified(pairs, queries, sets))
    asked = df.where("id % 5 = 0").withColumnsRenamed({"id": "q", "t": "a"})
    result = index.search(asked, "q", "a", "id", 5)
    met = result.select("q", "probed").distinct().agg(F.sum("probed")).first()[0]
    assert seen[0] < met / 3
    assert recall(grouped(result), brute(rows, [r for r in rows if r[0] % 5 == 0], 5, 0.5)) >= 0.97
    few = {"SETS_AT_ONCE": 50, "QUERIES_AT_ONCE": 30, "PAIRS_AT_ONCE": 40}
    for name, value in few.items():
        monkeypatch.setattr(S, name, value)
    assert sorted(index.search(asked.union(asked), "q", "a", "id", 5).distinct().collect())[0]["probed"] == sorted(result.collect())[0]["probed"]
    assert sorted(index.search(asked, "q", "a", "id", 5).collect()) == sorted(result.collect())


def test_only_pairs_that_may_be_among_the_best_are_fetched(spark, monkeypatch):
    """Of a group of near copies only the pairs that may be among the best move with their tokens, for small sets and for large ones."""
    rng, rows, seen = random.Random(5), [], []
    for size in (20, 150):
        words = [f"w{size}-{i}" for i in range(size)]
        for i in range(300):
            own = words[: size - 1 - i % (size // 3)]
            rows.append((len(rows), own + [f"v{len(rows)}"]))
    rows += [(1000 + i, rows[i][1][::-1]) for i in range(40)] + [(2000, None), (2001, []), (2002, [None, "w20-1"]), (2003, ["w20-1", None, None])]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "id long, t array<string>").repartition(3)
    index = S.BandIndex(spark, work_path(spark, "bands"), 0.5)
    index.add(df.where("id % 3 = 0"), "id", "t", "a")
    index.add(df.where("id % 3 > 0"), "id", "t", "b")
    verified = S._verified
    monkeypatch.setattr(S, "_verified", lambda pairs, queries, sets: seen.append(pairs.distinct().count()) or verified(pairs, queries, sets))
    asked = [r for r in rows if r[0] % 7 == 0 or r[0] > 1990]
    found = grouped(index.search(spark.createDataFrame(asked, "q long, a array<string>"), "q", "a", "id", 3))
    expected = {q: best for q, best in brute(rows, asked, 3, 0.5).items() if rows and best and q != 2001}
    assert {q: [i for i, _ in best] for q, best in found.items()} == {q: [i for i, _ in best] for q, best in expected.items()}
    assert seen == [sum(seen)] and seen[0] < 0.5 * sum(len(best) for best in brute(rows, asked, 1000, 0.5).values())


def test_tokens_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tokens(i):
        made.add(1)
        return [f"w{i % 10}", f"w{i}"]

    S.BandIndex(spark, work_path(spark, "bands"), 0.5).add(spark.range(50).select("id", tokens("id").alias("t")), "id", "t", "a")
    assert made.value == 50


def test_an_unfinished_batch_does_not_count(spark):
    index = S.BandIndex(spark, work_path(spark, "bands"), 0.5)
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, t array<string>")
    sets, members = S._classes(df, "id", "t")
    members.write.parquet(index._folder("members", "x"))  # stopped here
    asked = df.withColumnsRenamed({"id": "q", "t": "a"})
    assert index.search(asked, "q", "a", "id").collect() == []
    index.add(df, "id", "t", "x")
    assert [(r["q"], r["id"], r["score"]) for r in index.search(asked, "q", "a", "id").collect()] == [(1, 1, 1.0)]
    with pytest.raises(ValueError):
        index.add(df, "id", "t", "../x")
    with pytest.raises(ValueError):
        S.BandIndex(spark, index.path, 0.9).batches()


def vectors(spark, count=800, width=6):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(count, width)) + 4 * rng.normal(size=(12, width))[rng.integers(0, 12, count)]
    x[: count // 3] = x[0] + 0.01 * rng.normal(size=(count // 3, width))  # a third in one list
    x[5] = 0.0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(count, None)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(4)


@pytest.mark.parametrize("similarity", ["cosine", "l2"])
def test_vector_index_exact_and_probed(spark, similarity, monkeypatch):
    monkeypatch.setattr(X, "ROWS_PER_BLOCK", 40)
    monkeypatch.setattr(X, "QUERIES_PER_BLOCK", 30)
    rows = vectors(spark)
    queries = rows.where("id % 10 = 0 or id = 5").select(F.col("id").alias("q"), F.col("v").alias("a"))
    index = X.VectorIndex(spark, work_path(spark, "index"), similarity).build(rows, "id", "v", 25)
    assert spark.read.parquet(f"{index.path}/rows").count() == 800  # every vector is indexed
    expected = grouped(N.best_rows(rows, queries, "id", "q", "v", "a", similarity, 5))
    exact = index.search(queries, "q", "a", "id", 5, probes=1, exact=True)
    found = grouped(exact)
    assert {q: [i for i, _ in best] for q, best in found.items()} == {q: [i for i, _ in best] for q, best in expected.items()}
    assert exact.agg(F.avg("probed")).first()[0] < 20  # lists that cannot reach the k-th best are left out
    few = index.search(queries, "q", "a", "id", 5, probes=6)
    assert recall(grouped(few), expected) >= 0.9 and few.agg(F.max("probed")).first()[0] == 6


def test_vector_index_of_nothing(spark):
    rows = vectors(spark, 30)
    index = X.VectorIndex(spark, work_path(spark, "index")).build(rows.where("v is null"), "id", "v", 3)
    asked = rows.select(F.col("id").alias("q"), F.col("v").alias("a"))
    assert index.search(asked, "q", "a", "id").collect() == []
    full = X.VectorIndex(spark, work_path(spark, "index")).build(rows, "id", "v")
    assert full.search(asked.where("a is null"), "q", "a", "id").collect() == []


def test_registered_recalls(spark):
    import __spark_entry__ as entry

    folder, queries = "/root/testdata/sf0.01", entry.queries()
    exact = {}
    for r in queries["cosine_topk"](spark, folder).where("query_id % 20 = 0").collect():
        exact.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    found = grouped(queries["cosine_topk_probed"](spark, folder).withColumnRenamed("vec_id", "id"), "query_id")
    assert recall(found, exact) >= 0.9
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", S.F.regexp_extract_all("text", F.lit(N.V.TOKEN), 0).alias("t")).collect()
    rows = [(r["doc_id"], r["t"]) for r in docs]
    expected = brute(rows, [r for r in rows if r[0] % 20 == 0], 3, 0.5)
    found = grouped(queries["jaccard_topk_lsh"](spark, folder).withColumnRenamed("doc_id", "id"), "query_id")
    assert recall(found, expected) >= 0.9


@pytest.mark.parametrize("name,k", [("cosine_topk", 3), ("dot_topk", 2), ("dot_topk_in_blocks", 2), ("cosine_topk_bounded", 3)])
def test_every_vector_is_a_query(spark, tmp_path, name, k):
    """Also those whose id is not divisible by 20, in the query and in its SQL."""
    import duckdb

    import __spark_entry__ as entry

    x = np.random.default_rng(4).normal(size=(45, 5)).astype("float32")
    rows = [(7 * i + 3, v.tolist(), i % 3) for i, v in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = entry.queries()[name](spark, str(tmp_path)).select("query_id", "vec_id", "rank").collect()
    assert sorted({r["query_id"] for r in found}) == [i for i, _, _ in rows] and len(found) == k * len(rows)
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    expected = duck.execute(f"select query_id, vec_id, rank from ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_only_lists_that_are_looked_at_are_stored(spark, monkeypatch):
    """Not every list of every query; and vectors of single precision are not made wider to be moved."""
    seen, staged = {}, X.staged

    def counted(df, label):
        seen[label] = staged(df, label)
        return seen[label]

    monkeypatch.setattr(X, "staged", counted)
    rows = vectors(spark).withColumn("v", F.col("v").cast("array<float>"))
    queries = rows.where("v is not null").select(F.col("id").alias("q"), F.col("v").alias("a"))
    index = X.VectorIndex(spark, work_path(spark, "index")).build(rows, "id", "v", 25)
    exact = index.search(queries, "q", "a", "id", 3, probes=2, exact=True)
    expected = grouped(N.best_rows(rows, queries, "id", "q", "v", "a", "cosine", 3))
    assert {q: [i for i, _ in best] for q, best in grouped(exact).items()} == {q: [i for i, _ in best] for q, best in expected.items()}
    assert seen["vector-lists"].count() == 2 * 800 and seen["vector-more"].count() < 20 * 800
    assert dict(seen["vector-queries"].dtypes)["vector"] == "array<float>"
