import pytest
from pyspark.sql import functions as F

from millrace.functions.keys import content_hash
from millrace.operators import dedup, joins, profile
from millrace.operators.columns import computed_once


def test_known_questions_with_a_dominant_question(spark):
    """A third of all rows asks the same question."""
    df = spark.range(900).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("What is 12 + 1?")).otherwise(F.concat(F.lit("Who is no. "), F.chr(F.col("id") % 26 + 97))).alias("q"),
    )
    known = spark.createDataFrame([("what is  7 + 5",), ("WHO is no. b?",), ("other",)], "Problem string")
    kept = {r.id for r in joins.drop_known_questions(df, known, "q", "Problem").collect()}
    assert kept == {i for i in range(900) if i % 3 and i % 26 != 1}


def test_mismatch_prefix_and_exact(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    verdicts = spark.createDataFrame([(1, " MISMATCH: lost"), (2, "MISMATCH"), (3, "MATCH")], "question_id bigint, verdict string")
    assert [r.id for r in joins.drop_mismatches(df, verdicts, "id").collect()] == [3]
    assert sorted(r.id for r in joins.drop_mismatches(df, verdicts, "id", match="exact").collect()) == [1, 3]


def test_attached_text_is_never_null(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    texts = spark.createDataFrame([(1, "a"), (9, "b")], "k int, t string")
    assert sorted((r.id, r.rationale) for r in joins.attach_text(df, texts, "id", "k", "t").collect()) == [(1, "a"), (2, "")]


def test_keep_first_is_deterministic_and_idempotent(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("t"))
    once = dedup.keep_first(df, content_hash("t"), "id")
    kept = sorted(r.id for r in once.collect())
    first = {}
    for i in range(600):
        first.setdefault("hot" if i % 3 == 0 else str(i % 50), i)
    assert kept == sorted(first.values())
    assert sorted(r.id for r in dedup.keep_first(once, content_hash("t"), "id").collect()) == kept


def test_repeated_questions_ignore_choice_order(spark):
    rows = [(1, "q  x", ["a", "b"], "train"), (2, " q x", ["b", "a "], "train"), (3, "q x", ["a", "b"], "validation"), (4, "q x", ["a", "c"], "train")]
    df = spark.createDataFrame(rows, "id int, question string, choices array<string>, split string")
    assert sorted(r.id for r in dedup.drop_repeated_questions(df, "id").collect()) == [1, 4]
    assert sorted(r.id for r in dedup.drop_repeated_questions(df, "id", within="split").collect()) == [1, 3, 4]
    assert sorted(r.id for r in dedup.drop_repeated_questions(df, "id", ordered=True).collect()) == [1, 2, 4]


def test_computed_once_stops_filters(spark):
    df = computed_once(spark.range(10), v=F.col("id") * 2).where("v > 10")
    assert df.count() == 4 and df.columns == ["id", "v"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_composition_adds_up(spark):
    rows = [("a", "train")] * 3 + [("b", "train")] + [("b", "test")] * 4
    df = spark.createDataFrame(rows, "dataset string, split string")
    found = {(r.dataset, r.split): (r["rows"], r.percent) for r in profile.composition(df).collect()}
    assert found[("(all)", "(all)")] == (8, 100.0)
    assert found[("b", "(all)")] == (5, 62.5) and found[("(all)", "test")] == (4, 50.0) and found[("a", "train")] == (3, 37.5)
    card = profile.dataset_card(df, "T").collect()
    assert len(card) == 1 and "- **b**: 5 samples (62.5%)" in card[0].card


def test_answer_shares_list_missing_letters(spark):
    df = spark.createDataFrame([("t", "A"), ("t", "A"), ("t", "C"), ("t", "E")], "split string, answer string")
    found = {r.answer: (r["rows"], r.percent) for r in profile.answer_shares(df).collect()}
    assert found == {"A": (2, 50.0), "B": (0, 0.0), "C": (1, 25.0), "D": (0, 0.0)}
    assert {r.answer for r in profile.answer_shares(df, letters=None).collect()} == {"A", "C", "E"}


def test_card_of_many_sources(spark):
    df = spark.range(500).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("dataset"), F.lit("train").alias("split"))
    df = df.union(df.where("dataset = 's7'"))
    card = profile.dataset_card(df, "T", most=3).first()["card"]
    assert card.count("- **s") == 3 and "**s7**: 2 samples" in card and "- and 497 more" in card and "501 samples.\n" in card
    assert profile.card_lines(df).count() == 1 + 500 + 1 + 500
