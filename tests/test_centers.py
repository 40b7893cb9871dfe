import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import nearest as N
from millrace.operators.centers import Centers, squared


def slow(x, centers):
    distances = np.stack([squared(x, c) for c in centers], axis=1)
    return distances.argmin(axis=1), distances.min(axis=1)


@pytest.mark.parametrize("offset,spread", [(0, 1), (1e7, 1e-3), (1e7, 1), (-3e5, 1e-6), (0, 0)])
@pytest.mark.parametrize("grouped_from", [2, 10_000])
def test_nearest_is_that_of_the_differences(offset, spread, grouped_from):
    rng = np.random.default_rng(1)
    centers, x = (offset + spread * rng.normal(size=(n, 12)) for n in (300, 500))
    centers[7], centers[250] = centers[20], x[3]  # equal centers, a center on a row
    own, d2 = Centers(centers, grouped_from).nearest(x)
    expected, least = slow(x, centers)
    assert np.array_equal(own, expected) and np.array_equal(d2, least)


def test_groups_of_very_different_scales():
    rng = np.random.default_rng(2)
    centers = np.concatenate([scale + scale * rng.normal(size=(100, 4)) for scale in (1e-6, 1.0, 1e6)])
    x = np.concatenate([centers + 1e-7, rng.normal(size=(50, 4)), np.zeros((1, 4))])
    assert np.array_equal(Centers(centers, 2).nearest(x)[0], slow(x, centers)[0])


def lloyd(x, centers, steps):
    for _ in range(steps):
        own, _ = slow(x, centers)
        centers = np.array([c + (x[own == i] - c).mean(axis=0) if (own == i).any() else c for i, c in enumerate(centers)])
    return centers


def test_thousand_centers_and_25_steps_like_lloyd(spark):
    """Also: what tasks pass on is little more than one sum per center."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 8)) + 10 * rng.integers(0, 9, (6000, 1))
    x[:2000] = x[0] + 0.1 * rng.normal(size=(2000, 8))  # a third of the rows in one place
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(16)
    ordered = [r["id"] for r in rows.orderBy(N.hash_key(N.V.SEED, "id"), "id").limit(1000).collect()]
    centers = N.cluster_centers(rows, "id", "v", 1000, 25)
    assert np.allclose(centers, lloyd(x, x[ordered], 25), atol=1e-9)
    given = N._by_region(rows.select("id", F.col("v").alias("__value")), "id", x[ordered])
    sums, _ = N.center_sums(given, x[ordered])
    assert given.rdd.getNumPartitions() > 1 and sums.count() < 2 * 1000


def test_far_from_the_origin(spark):
    rng = np.random.default_rng(6)
    x = 1e7 + 1e-3 * rng.normal(size=(400, 5))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(4)
    ordered = [r["id"] for r in rows.orderBy(N.hash_key(N.V.SEED, "id"), "id").limit(20).collect()]
    found = N.diverse_rows(rows, "id", "v", 20, 0, mode="assigned").collect()
    own, d2 = slow(x, x[ordered])
    for row in found:
        mine = np.flatnonzero(own == row["cluster"])
        assert row["d2"] == d2[mine].min() and row["id"] in mine[d2[mine] == d2[mine].min()]
    assert len(found) == len(set(own.tolist()))
