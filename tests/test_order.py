import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.operators import order as O
from millrace.operators import splits as P


def key(seed, value):
    return hashlib.md5(f"{seed}:{value}".encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows carries group 'hot'."""
    return spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 5 == 0, "validation").otherwise("train").alias("split"),
    ).persist()


def test_rank_is_dense_per_group(rows):
    found = O.with_rank(rows, O.hash_order("id"), ["g"]).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.g, []).append((r["rank"], key(42, r.id)))
    for pairs in groups.values():
        pairs.sort()
        assert [p[0] for p in pairs] == list(range(1, len(pairs) + 1))
        assert [p[1] for p in pairs] == sorted(p[1] for p in pairs)


@pytest.mark.parametrize("partitions", [1, 17])
def test_results_do_not_depend_on_partitions(spark, rows, partitions):
    reference = sorted(O.with_rank(rows, O.hash_order("id")).select("id", "rank").collect())
    split = sorted(P.three_way_split(rows, "id", group=["g"], split="s").select("id", "s").collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        other = rows.repartition(partitions)
        assert sorted(O.with_rank(other, O.hash_order("id")).select("id", "rank").collect()) == reference
        assert sorted(P.three_way_split(other, "id", group=["g"], split="s").select("id", "s").collect()) == split
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_number_order_with_uneven_ids(spark):
    ids = [*range(100), *(10**12 + i * i for i in range(100)), -5, -(10**15)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    found = O.row_index(df, O.number_order(df, "id", parts=16)).orderBy("id").collect()
    assert [r.id for r in found] == sorted(ids)
    assert [r.row_index for r in found] == list(range(len(ids)))


def test_sample_is_exact_and_capped(rows):
    wanted = sorted(range(3000), key=lambda i: key(42, i))[:137]
    assert sorted(r.id for r in O.sample_rows(rows, "id", 137).collect()) == sorted(wanted)
    assert O.sample_rows(rows, "id", 5000).count() == 3000
    assert O.sample_rows(rows, "id", 0).count() == 0


def test_holdout_and_top_up(rows):
    train = [i for i in range(3000) if i % 5]
    moved = set(sorted(train, key=lambda i: key(42, i))[:400])
    found = {r.id: r.split for r in P.holdout(rows, "id", 400).collect()}
    assert all(found[i] == ("validation" if i % 5 == 0 or i in moved else "train") for i in range(3000))
    topped = P.top_up_validation(rows, "id", share=0.08)
    assert topped.where("split = 'validation'").count() == 600 + int(2400 * 0.08)
    assert P.top_up_validation(rows, "id", rows=150).where("split = 'validation'").count() == 750


def test_three_way_sizes_are_exact(rows):
    counts = {}
    for r in P.three_way_split(rows, "id", group=["g"], split="s").groupBy("g", "s").count().collect():
        counts.setdefault(r.g, {})[r.s] = r["count"]
    for sizes in counts.values():
        n = sum(sizes.values())
        assert sizes["test"] == sizes["validation"] == int(n * 0.1)


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id int, g string")
    assert P.three_way_split(df, "id", group=["g"]).count() == 40
    ranks = sorted(r["rank"] for r in O.with_rank(df, O.hash_order("id"), ["g"]).where("g is null").collect())
    assert ranks == list(range(1, 21))


def test_batches_and_empty_input(spark, rows):
    batches = O.row_batches(rows, O.hash_order("id"), 64).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in batches) == [3000 % 64] + [64] * (3000 // 64)
    empty = rows.where("id < 0")
    assert P.three_way_split(empty, "id").count() == 0
    assert O.row_index(empty, O.number_order(empty, "id")).count() == 0


def test_building_a_plan_runs_no_job(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    P.three_way_split(rows, "id", group=["g"], split="s")
    O.with_rank(rows, O.hash_order("id"), ["g"])
    O.sample_rows(rows, "id", 10)
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_clashing_columns_are_refused(rows):
    with pytest.raises(ValueError):
        O.with_rank(rows.withColumn("rank", F.lit(1)), O.hash_order("id"))


def test_plans_have_no_cross_join_and_no_global_window(rows):
    plan = P.three_way_split(rows, "id", group=["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan


def test_split_helpers(spark):
    df = spark.createDataFrame(
        [(1, "a", "train"), (2, "a", "validation"), (3, "b", "test"), (4, "b", "train"), (5, "a", "test")],
        "id int, dataset string, split string",
    )
    assert sorted(r.id for r in P.evaluation_split(df).collect()) == [2, 3]
    assert sorted(r.id for r in P.drop_split(df).collect()) == [1, 2, 4]
    fraction = P.random_fraction(spark.range(4000), "id", 0.15).count()
    assert 500 < fraction < 700
