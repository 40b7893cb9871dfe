import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.keys import content_hash
from millrace.functions.rules import has_text
from millrace.functions.text import normalize_spaces
from millrace.operators.workers import batch_predicate, embed, enrich
from millrace.operators.filtering import within_budget
from millrace.functions.tokens import token_counter, token_encoder
from millrace.session import staged, work_path
from millrace.sources import readers, writers
from millrace.streaming import incremental

HARD = [(1, 'a "quoted", text', "x"), (2, "two\nlines", ""), (3, "back\\slash \\\" end\\", " padded "), (4, "ümlaut", "y")]


def test_csv_keeps_line_breaks_and_edges(spark):
    path = work_path(spark, "csv")
    df = spark.createDataFrame(HARD, "id int, question string, answer string")
    writers.write_quoted_csv(df, path, ["question", "answer"])
    found = {(r.question, r.answer) for r in readers.read_csv(spark, path, "question string, answer string").collect()}
    assert found == {(q.replace('"', "'"), a or None) for _, q, a in HARD}


def test_json_batches_and_lists(spark, tmp_path):
    for split, number, ids in (("train", 0, [1, 2]), ("train", 1, [3]), ("validation", 0, [4])):
        (tmp_path / f"{split}_batch_{number:03}.json").write_text(json.dumps([{"id": i} for i in ids], indent=2))
    found = readers.read_json_batches(spark, str(tmp_path), "id int").collect()
    assert sorted((r.split, r.batch_no, r.id) for r in found) == [
        ("train", 0, 1), ("train", 0, 2), ("train", 1, 3), ("validation", 0, 4)]
    one = readers.read_json_list(spark, str(tmp_path / "train_batch_000.json"), "id int")
    assert sorted(r.id for r in one.collect()) == [1, 2]


def test_catalog_reads_one_split_only(spark):
    path = work_path(spark, "shards")
    df = spark.range(100).withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    writers.write_shards(df, path, max_records=10)
    catalog = readers.Catalog({"numbers/all": readers.Source(path)})
    test = catalog.load(spark, "numbers", "all", "test")
    assert test.count() == 25
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert catalog.load(spark, "numbers", "all").count() == 100


def test_append_resumes(spark):
    path = work_path(spark, "append")
    writers.append_new_rows(spark.range(10), path, "id")
    writers.append_new_rows(spark.range(15), path, "id")
    writers.append_new_rows(spark.range(15), path, "id")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(15))


def test_json_and_staged(spark):
    path = work_path(spark, "json")
    df = spark.createDataFrame(HARD, "id int, question string, answer string")
    writers.write_json(df, path)
    assert sorted(spark.read.schema(df.schema).json(path).collect()) == sorted(df.collect())
    assert sorted(staged(df, "rows").collect()) == sorted(df.collect())


def test_work_path_uses_the_shared_folder(spark):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name.replace(".", "_"), default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    shared = work_path(Session(spark_checkpoint_dir="hdfs://a/b/", spark_master="yarn"), "x")
    assert shared.startswith("hdfs://a/b/x-")
    with pytest.raises(ValueError):
        work_path(Session(spark_master="yarn"), "x")


def test_stream_equals_batch_over_several_runs(spark):
    source, sink, state = (work_path(spark, n) for n in ("source", "sink", "state"))

    def chain(df):
        return df.select("id", normalize_spaces("t").alias("t")).where(has_text("t"))

    rows = [(i, " a  b " if i % 3 else " ") for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    for part in (df.where("id < 10"), df.where("id >= 10")):
        part.coalesce(2).write.mode("append").parquet(source)
        stream = incremental.new_files(spark, source, df.schema, files_per_trigger=1)
        incremental.append_stream(stream, chain, sink, state).awaitTermination()
    found = sorted(spark.read.parquet(sink).collect())
    assert found == sorted(chain(df).collect())


def test_stream_dedup_over_several_runs(spark):
    source, sink, state = (work_path(spark, n) for n in ("source", "sink", "state"))
    for start in (0, 5):
        spark.range(start, start + 20).select(F.col("id"), (F.col("id") % 12).cast("string").alias("t")).write.mode("append").parquet(source)
        stream = incremental.new_files(spark, source, spark.read.parquet(source).schema)
        incremental.append_stream(
            stream, lambda s: incremental.first_seen(s, content_hash("t")).select("content_key"), sink, state
        ).awaitTermination()
    keys = [r.content_key for r in spark.read.parquet(sink).collect()]
    assert len(keys) == len(set(keys)) == 12


def test_predicate_falls_back_to_rows(spark):
    rule = batch_predicate(lambda ids: [10 // i > 1 for i in ids])
    assert sorted(r.id for r in spark.range(8).where(rule("id")).collect()) == [1, 2, 3, 4, 5]
    both = batch_predicate(lambda a, b: [x == y for x, y in zip(a, b)])
    assert spark.range(3).withColumn("b", F.lit(1)).where(both("id", "b")).count() == 1


def test_embed_batches_and_enrich_retries(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(20)], "id int, t string")
    sizes = embed(df, "t", lambda texts: [[len(t), len(texts)] for t in texts], batch=4).collect()
    assert all(r.embedding[0] == r.id and r.embedding[1] <= 4 for r in sizes)

    def write(request):
        if len(request) > 10:
            raise RuntimeError
        return f" {request}! "

    found = {r.id: r.rationale for r in enrich(df, "t", write, retries=2, wait=0).collect()}
    assert found[3] == "xxx!" and found[11] == ""


def test_user_tokenizers(spark):
    counter = token_counter(lambda: lambda texts: [len(t.split()) for t in texts])
    encode = token_encoder(lambda: lambda texts: [[len(w) for w in t.split()] for t in texts])
    df = spark.createDataFrame([(1, "a bb ccc"), (2, "a b c d"), (3, None)], "id int, t string")
    assert sorted((r.id, r.tokens) for r in within_budget(df, "t", 3, counter).collect()) == [(1, 3), (3, 0)]
    assert df.where("id = 1").select(encode("t").alias("x")).first().x == [1, 2, 3]
