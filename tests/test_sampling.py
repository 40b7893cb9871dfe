import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import sampling as W


def key(seed, value):
    return hashlib.md5(f"{seed}:{value}".encode()).hexdigest()


def expected_draws(weights, seed=42):
    line, end = [], 0
    for i in sorted(weights, key=lambda i: key(seed, i)):
        end += weights[i]
        line.append((end, i))
    found = Counter()
    for i in weights:
        point = int(key(f"{seed}-draw", i)[:15], 16) % end
        low, high = 0, len(line) - 1
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if point < line[middle][0] else (middle + 1, high)
        found[line[low][1]] += 1
    return found


@pytest.mark.parametrize("name, weight", [
    ("even", lambda i: 1), ("classes", lambda i: (10, 4, 7, 1)[i % 4]),
    ("one heavy row", lambda i: 10**9 if i == 7 else 1), ("third of the line", lambda i: 750 if i == 7 else 1),
    ("growing", lambda i: i * i + 1),
])
@pytest.mark.parametrize("digits", [1, 3])
def test_weighted_resample_matches_brute_force(spark, name, weight, digits):
    weights = {i: weight(i) for i in range(1500)}
    df = spark.createDataFrame(list(weights.items()), "id bigint, w bigint")
    found = W.weighted_resample(df, "id", "w", digits=digits).collect()
    assert len(found) == 1500
    assert Counter(r.id for r in found) == expected_draws(weights)
    copies = {}
    for r in found:
        copies.setdefault(r.id, []).append(r.copy)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())


def test_rows_without_weight_take_no_part(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 0), (4, 5)], "id int, w int")
    assert {r.id for r in W.weighted_resample(df, "id", "w").collect()} <= {1, 4}
    assert W.weighted_resample(df.where("w = 0"), "id", "w").count() == 0


def test_weight_lookup(spark):
    df = spark.createDataFrame([("Anatomy",), ("Surgery",), ("Other",)], "s string")
    found = [r.w for r in df.select(W.weight_of("s", {"Anatomy": 0.1, "Surgery": 0.04}).alias("w")).collect()]
    assert found == [5, 2, None]  # exact proportion
    assert W.whole_weights({"a": 0.004, "b": 0.125, "c": 1}) == {"a": 4, "b": 125, "c": 1000}


def test_mix_shares_and_exhaustion(spark):
    rows = [(i, "a") for i in range(3)] + [(i, "b") for i in range(10)] + [(i, "c") for i in range(4)] + [(1, "z")]
    df = spark.createDataFrame(rows, "id int, dataset string")
    found = W.mix_sources(df, "id", {"a": 0.2, "b": 0.5, "c": 0.3}).collect()
    assert Counter(r.dataset for r in found) == {"a": 4, "b": 10, "c": 6}
    assert {(r.id, r.dataset) for r in found} == set(rows) - {(1, "z")}
    ordered = df.where("dataset <> 'z'").withColumn("copy", F.lit(1)).orderBy(W.mix_order("id"))
    assert ordered.count() == 17
