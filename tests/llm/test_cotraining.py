import numpy as np
from pyspark.sql import functions as F

from millrace.llm import op7_cotraining as c


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 1200)
    left = (rng.normal(0, 1, (1200, 4)) + y[:, None] * 1.5).astype(np.float32)
    right = (rng.normal(0, 1, (1200, 4)) + y[:, None] * 1.5).astype(np.float32)
    seen = np.where(np.arange(1200) < 60, y, -1)
    model = c.co_train([left, right], seen, np.arange(1200) % 5 == 0)
    alone = c.logistic(left[:60], y[:60])
    a, b, e, f = model["scale"]
    both = np.stack((a * c.odds(left, model["text"]) + b, e * c.odds(right, model["meta"]) + f), 1)
    right_now = ((c.odds(both, model["mix"]) > 0) == y)[60:].mean()
    assert right_now > ((c.odds(left, alone) > 0) == y)[60:].mean() and right_now > 0.9


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = c.op7_cotraining(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert np.mean([r["quality_pred"] == r["quality"] for r in rows]) > 0.9


def test_labels_that_were_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = c.learn(docs, labels.where("doc_id % 2 = 0").select("doc_id", "quality"))
    rows = c.score(docs, model).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("quality").alias("truth")), "doc_id").collect()
    assert len(rows) > 200 and np.mean([(r["score"] > 0.5) == (r["truth"] == 1) for r in rows if r["truth"] is not None]) > 0.9


def test_edges(spark, docs_of):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "", "x", "y", 0), (2, "a" * 300_000, "x", "y", 300_000)], schema)
    for labels in ([], [(1, 1)], [(1, 1), (2, 1)]):
        model = c.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert all(0 <= r["score"] <= 1 for r in c.score(docs, model).collect())
    assert c.score(docs.limit(0), model).count() == 0
