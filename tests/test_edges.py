"""Rows that the test views never contain: absent keys, nulls, wrong letters, defaults that must keep everything."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import choices as C
from millrace.functions import prompts as P
from millrace.functions.keys import content_hash
from millrace.operators import dedup, joins, sequences, shape
from millrace.plans.preference import preference_corpus
from millrace.plans.quantised import quantised_sequences
from millrace.streaming.incremental import first_seen


def test_absent_answer_key_is_rejected(spark):
    schema = "row_id int, question string, choices struct<text array<string>, label array<string>>, answerKey string"
    four = (["w", "x", "y", "z"], ["A", "B", "C", "D"])
    five = (["v", "w", "x", "y", "z"], ["1", "2", "3", "4", "5"])
    raw = spark.createDataFrame([(1, "q", four, "B"), (2, "q", four, "Z"), (3, "q", five, "9"), (4, "q", four, None), (5, "q", five, "5")], schema)
    kept = shape.from_arc(raw).collect()
    assert sorted(r.row_id for r in kept) == [1, 5]
    assert all(r.choices[ord(r.answer) - 65] == {1: "x", 5: "z"}[r.row_id] for r in kept)
    assert sorted(r.row_id for r in shape.without_key(raw).collect()) == [2, 3, 4]


def test_null_keys_are_equal_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "id int, t string")
    assert sorted(r.id for r in dedup.keep_first(df, F.md5("t"), "id").collect()) == [1, 2, 3]
    assert sorted(r.id for r in dedup.drop_repeated_questions(df, "id", "t", None).collect()) == [1, 2, 3]
    known = spark.createDataFrame([(None,), ("a",)], "Problem string")
    assert sorted(r.id for r in joins.drop_known_questions(df, known, "t", "Problem").collect()) == [1, 2]


def test_null_choices_count(spark):
    df = spark.createDataFrame([(["a", None],), (["a"],), ([None, "a"],)], "c array<string>")
    hashes = [r.h for r in df.select(content_hash(F.lit("q"), "c").alias("h")).collect()]
    assert hashes[0] == hashes[2] != hashes[1]


def test_only_one_letter_is_an_answer(one):
    assert one(C.position_of, ["Answer B", "b", " C ", "", "1", None, "AB"]) == [None, 1, 2, None, None, None, None]


def test_an_answer_past_the_shown_choices_has_no_completion(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e"], "E"), (["a", "b", "c", "d", "e"], "D")], "c array<string>, a string")
    found = [r.p for r in df.select(P.quiz_completion("c", "a", F.lit("r")).alias("p")).collect()]
    assert found[0] is None and found[1].startswith(" D. d")


def test_lateness_has_to_be_given(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        first_seen(stream, F.col("value"), time="timestamp")


def test_defaults_keep_all_rows(spark):
    quiz = spark.range(300).select("id", F.lit("q").alias("question"), F.array(F.lit("a"), F.lit("b")).alias("choices"),
                                   F.lit("A").alias("answer"), F.lit("r " * 600).alias("rationale"))
    rows = quantised_sequences(quiz, "id")
    assert rows.count() == 300 and rows.where("dropped > 0").count() == 300
    pairs = spark.range(50).select(F.col("id").alias("row_id"), F.lit("p").alias("prompt"), F.lit("good answer").alias("chosen"), F.lit("bad answer").alias("rejected"))
    assert preference_corpus(pairs, pairs.limit(0)).count() == preference_corpus(pairs, pairs.limit(0), math_rows=1000).count()


def test_end_mark_and_dropped_tokens(spark):
    df = spark.createDataFrame([([1, 2], [3, 4])], "p array<int>, c array<int>")
    row = sequences.masked_sequences(df, "p", "c", 4, end_id=9).first()
    assert (row.input_ids, row.labels, row.dropped) == ([1, 2, 3, 4], [-100, -100, 3, 4], 1)
    row = sequences.masked_sequences(df, "p", "c", 8, end_id=9).first()
    assert (row.input_ids[-1], row.labels[-1], row.dropped) == (9, 9, 0)


def test_canonical_anti_join_shuffles_digests_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, q string")
    known = spark.createDataFrame([("a",)], "Problem string")
    plan = joins.drop_known_questions(df, known, "q", "Problem")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [__known" in plan and "Join LeftAnti, (__key" in plan
