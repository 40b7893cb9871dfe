import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import filtering, sampling
from millrace.operators import order as O
from millrace.operators import sequences as Q
from millrace.session import work_path
from millrace.sources import writers as W


def test_clustered_ids_and_no_bucket_above_the_bound(spark):
    """A million ids in a few dense clusters far apart, negative ones too."""
    ids = spark.range(1_000_000).select(F.expr("CASE WHEN id < 990000 THEN id + 5000000000 WHEN id < 999990 THEN -id ELSE id * 1000000000000 END").alias("id"))
    order = O.number_order(ids, "id", most=20_000)
    counts = ids.groupBy(order.bucket.alias("b")).agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).orderBy("b").collect()
    assert max(r["n"] for r in counts) <= 20_000 and len(counts) < 1_000
    assert all(a["high"] < b["low"] for a, b in zip(counts, counts[1:], strict=False))  # buckets follow the order
    ranked = O.with_rank(ids, order)
    assert ranked.agg(F.count("*"), F.count_distinct("rank"), F.min("rank"), F.max("rank")).first() == (1_000_000, 1_000_000, 1, 1_000_000)
    wrong = ranked.where("id > 5000000000 and id < 5000990000 and rank <> id - 5000000000 + 9990 + 1")
    assert wrong.isEmpty()


def test_equal_ids_and_nothing(spark):
    df = spark.createDataFrame([(5,)] * 40 + [(7,)] * 3, "id long")
    order = O.number_order(df, "id", most=4)
    assert {r["n"] for r in df.groupBy(order.bucket.alias("b")).agg(F.count("*").alias("n")).collect()} == {40, 3}
    assert O.with_rank(df.limit(0), O.number_order(df.limit(0), "id")).collect() == []
    real = spark.createDataFrame([(x / 7,) for x in range(50)], "id double")
    assert [r["rank"] for r in O.with_rank(real, O.number_order(real, "id")).orderBy("id").collect()] == list(range(1, 51))


def test_digits_and_rows_from_counts(spark):
    assert O.hash_order("id", rows=100, most=10).bucket is not None
    df = spark.range(3000)
    fine = df.groupBy(O.hash_order("id", digits=1, rows=3000, most=100).bucket).count().agg(F.max("count")).first()[0]
    assert fine < 100
    assert O.rows_for(df.withColumn("t", F.repeat(F.lit("x"), 1000)), F.octet_length("t"), 10_000) == 10


def test_resample_does_not_depend_on_the_pieces(spark):
    df = spark.createDataFrame([(i, 1 + i % 7 * 50) for i in range(400)], "id long, w long")
    found = [sorted(map(tuple, sampling.weighted_resample(df, "id", "w", digits=d).select("id", "copy").collect())) for d in (None, 1, 3)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 400


@pytest.mark.parametrize("share", [0.0, 0.1, 0.37, 0.5, 1.0])
def test_quantile_in_two_passes(spark, share):
    rng = random.Random(1)
    rows = [(g, int(rng.paretovariate(0.5))) for g in ("a", "b", "b", "b", None) for _ in range(4001)] + [("one", 5), ("two", 1), ("two", 2), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    expected = {r["g"]: r["q"] for r in df.where("v is not null").groupBy("g").agg(F.percentile("v", F.lit(share)).alias("q")).collect()}
    for accuracy in (1000, 50):  # the second brackets every group
        found = {r["g"]: r["__cut"] for r in filtering.exact_quantile(df, F.col("v"), share, ["g"], accuracy).collect()}
        assert found == pytest.approx(expected)


def test_quantile_of_a_million_lengths(spark):
    df = spark.range(1_000_000).select(F.lit("train").alias("split"), ((F.col("id") * 7_919) % 1_000_003 + 1).alias("v"))
    expected = df.agg(F.percentile("v", F.lit(0.1))).first()[0]
    rows = filtering.exact_quantile(df, F.col("v"), 0.1, ["split"])
    assert rows.first()["__cut"] == expected


def test_masked_token_sequences_are_those_of_whole_lists(spark):
    rows = [(i, ["t"] * a + ["u"] * (a % 2), ["v", "w"] * b) for i, (a, b) in enumerate([(0, 0), (3, 1), (6, 9), (9, 0), (5, 0), (2, 1)])]
    df = spark.createDataFrame(rows, "id int, p array<string>, c array<string>")
    for end in (None, 9):
        short = Q.masked_token_sequences(df, "p", "c", limit=6, end_id=end).drop("p", "c")
        ids = df.select("id", Q.hashed_ids("p").alias("p"), Q.hashed_ids("c").alias("c"))
        assert sorted(map(tuple, short.collect())) == sorted(map(tuple, Q.masked_sequences(ids, "p", "c", 6, end).select(short.columns).collect()))


def test_files_of_a_stated_size(spark):
    """All shards but the last within 10 % of the size, with one text longer than a shard's tenth."""
    rng = random.Random(2)
    rows = [(i * 3 - 500, "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(50, 4000)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(7)
    path = work_path(spark, "sized")
    W.write_sized_shards(df, path, "id", F.octet_length("text"), 200_000)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("id", "text").collect())) == sorted(rows)
    files = back.select("shard", "id", F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_path").alias("f"))
    sizes = files.groupBy("shard").agg(F.count_distinct("f").alias("files"), F.max("size").alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).orderBy("shard").collect()
    assert len(sizes) >= 5 and all(r["files"] == 1 for r in sizes)
    assert all(abs(r["size"] - 200_000) < 20_000 for r in sizes[:-1])
    assert all(a["high"] < b["low"] for a, b in zip(sizes, sizes[1:], strict=False))


def test_sized_shards_edges(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 25), (4, 1), (5, 9)], "id long, w long")
    rows = W.sized_shards(df, O.number_order(df, "id"), F.col("w"), 10).orderBy("id").collect()
    assert [r["shard"] for r in rows] == [0, 0, 0, 3, 3]
    assert W.sized_shards(df.limit(0), O.number_order(df, "id"), F.col("w"), 10).collect() == []
