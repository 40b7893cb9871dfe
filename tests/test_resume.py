import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators import workers
from millrace.session import work_path
from millrace.sources import readers as R
from millrace.sources import writers as W
from millrace.streaming import incremental as I


def test_a_stop_between_rows_and_ledger(spark):
    folder, checkpoint = work_path(spark, "in"), work_path(spark, "checkpoint")
    out, runs = I.BatchTable(spark, work_path(spark, "out")), []

    def stop(number):
        runs.append(number)
        if runs.count(number) == 1 and number == 1:
            raise InterruptedError

    schema = spark.range(1).schema
    for start in (0, 100, 200):
        spark.range(start, start + 100).write.mode("append").parquet(folder)
        before = out.read(schema).count()
        for _ in range(3):
            try:
                I.append_batches(I.new_files(spark, folder, schema), lambda rows: rows.where("id % 10 > 0"), out, checkpoint, stop).awaitTermination()
            except StreamingQueryException:
                assert out.read(schema).count() == before  # rows without an entry in the ledger do not count
    assert sorted(r["id"] for r in out.read(schema).collect()) == [i for i in range(300) if i % 10]
    assert runs == [0, 1, 1, 2] and out.batches() == [0, 1, 2]


def test_a_repeated_batch_is_not_computed(spark):
    out = I.BatchTable(spark, work_path(spark, "out"))
    assert out.read(spark.range(1).schema).collect() == []
    out.write(spark.range(3), 0)
    out.write(spark.range(50), 0)
    assert out.read(spark.range(1).schema).count() == 3


def test_keys_age_and_come_back(spark):
    """Also with a row out of order within a delivery, and rows that are too late."""
    folder, checkpoint, sink = (work_path(spark, name) for name in ("in", "checkpoint", "sink"))
    deliveries = [
        [(1, "a", 0), (3, "a", 50), (2, "a", 20), (4, "b", 30)],
        [(5, "a", 100), (6, "b", 200), (7, None, 210), (8, "c", None)],
        [(9, "a", 161), (10, "c", 300), (11, "b", 261), (12, "b", 199)],
        [(13, "a", 400), (14, "b", 321), (15, "c", 360)],
    ]
    for rows in deliveries:
        made = spark.createDataFrame(rows, "id long, k string, s long").select("id", "k", F.timestamp_seconds(F.col("s") + 100_000).alias("ts"))
        made.write.mode("append").parquet(folder)
        stream = I.new_files(spark, folder, made.schema)
        I.append_stream(stream, lambda s: I.seen_after_pause(s, F.col("k"), "ts", "id", 60, "1000 seconds"), sink, checkpoint).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 4, 6, 9, 10, 11, 13]


def test_old_keys_leave_the_state(spark):
    folder, checkpoint, sink = (work_path(spark, name) for name in ("in", "checkpoint", "sink"))
    kept = []
    for step in range(4):
        made = spark.range(100).select("id", F.concat(F.lit(f"{step}-"), F.col("id").cast("string")).alias("k"), F.timestamp_seconds(F.lit(100_000 + step * 1000)).alias("ts"))
        made.write.mode("append").parquet(folder)
        run = I.append_stream(I.new_files(spark, folder, made.schema), lambda s: I.seen_after_pause(s, F.col("k"), "ts", "id", 60, "0 seconds"), sink, checkpoint)
        run.awaitTermination()
        kept.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(kept) <= 200 and spark.read.parquet(sink).count() == 400


def test_state_is_kept_by_buckets_of_keys(spark):
    """Many keys share few state rows, and each key still has its own pause."""
    folder, checkpoint, sink = (work_path(spark, name) for name in ("in", "checkpoint", "sink"))
    rows = [(i, f"k{i * 7 % 300}", i // 400 * 40 + i * 31 % 90) for i in range(1600)]
    kept, last, expected = [], {}, set()
    for part in range(4):
        own = rows[part * 400 : part * 400 + 400]
        made = spark.createDataFrame(own, "id long, k string, s long").select("id", "k", F.timestamp_seconds(F.col("s") + 100_000).alias("ts"))
        made.write.mode("append").parquet(folder)
        run = I.append_stream(I.new_files(spark, folder, made.schema), lambda s: I.seen_after_pause(s, F.col("k"), "ts", "id", 30, "1000 seconds", buckets=5), sink, checkpoint)
        run.awaitTermination()
        kept.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
        for i, k, at in sorted(own, key=lambda r: (r[2], r[0])):
            if k not in last or at - last[k] > 30:
                expected.add(i)
            last[k] = max(at, last.get(k, at))
    assert max(kept) <= 5 and {r["id"] for r in spark.read.parquet(sink).collect()} == expected and len(expected) > 300


def test_requests_are_sent_once(spark, tmp_path):
    """A run that breaks off loses no answer; refused rows are tried with pauses and do not stop the others."""
    log, path = tmp_path / "log", work_path(spark, "answers")
    os.mkdir(log)

    def write(request, breaks=False):
        with open(log / f"{request}-{time.time_ns()}", "w"):
            pass
        if breaks and request == "r17":
            os._exit(1)
        if request == "r5":
            raise ValueError("refused")
        return f" got {request} "

    df = spark.createDataFrame([(i, f"r{i}" if i != 7 else None) for i in range(30)], "id long, request string").repartition(3)

    def run(rows, breaks=False):
        return workers.enrich_resumed(rows, "id", "request", lambda r: write(r, breaks), path, parallel=4, retries=3, wait=0.01, wave_rows=10)

    first = run(df.where("id < 12")).count()
    sent = len(list(log.iterdir()))
    with pytest.raises(Exception):  # noqa: B017 - the worker is gone
        run(df, True)
    stored = spark.read.parquet(f"{path}/answers").select("__id").distinct().count()
    assert first == 12 and sent == 13 and stored >= 12  # eleven requests, one of them three times
    found = {r["id"]: r for r in run(df).collect()}
    assert len(found) == 30 and found[3]["rationale"] == "got r3" and found[3]["tries"] == 1
    assert found[5]["rationale"] is None and found[5]["tries"] == 3 and "refused" in found[5]["error"] and found[7]["tries"] == 0
    counts = {}
    for name in os.listdir(log):
        counts[name.split("-")[0]] = counts.get(name.split("-")[0], 0) + 1
    assert all(counts[f"r{i}"] == 1 for i in range(12) if i not in (5, 7)) and counts["r5"] == 3
    before = len(list(log.iterdir()))
    assert run(df).count() == 30 and len(list(log.iterdir())) == before


def test_json_batches_in_files_and_folders(spark, tmp_path):
    df = spark.createDataFrame([(i, f"line\n{i}") for i in range(20)], "id long, t string")
    for number in (10, 2):
        W.write_json_batch(df.where(f"id % 2 = {number // 10}"), str(tmp_path), "my_train", number)
        W.write_json_batch(df.where(f"id % 2 = {number // 10}"), str(tmp_path), "my_train", number)
    rows = R.read_json_batches(spark, str(tmp_path), "id long, t string", lines=True).collect()
    assert sorted((r["id"], r["t"], r["split"], r["batch_no"]) for r in rows) == [(i, f"line\n{i}", "my_train", 10 if i % 2 else 2) for i in range(20)]
    assert R.read_json_batches(spark, str(tmp_path), "id long, t string", "my_train", True).count() == 20
