from pyspark.sql import functions as F

from millrace.functions import choices as C
from millrace.functions import prompts as P
from millrace.operators import shape as S


def rows_of(spark, n=200):
    rows = [(i, [f"c{i}-{k}" for k in range(5)], "ABCDE"[i % 5]) for i in range(n)]
    return spark.createDataFrame(rows, "row_id bigint, choices array<string>, answer string")


def test_strip_letters(spark):
    df = spark.createDataFrame([(["(A)* x", "B)C) y", "(A)(B)z", "F) w", " A) v"],)], "o array<string>")
    assert df.select(C.strip_letter_prefixes("o").alias("o")).first()["o"] == ["x", "y", "z", "F) w", "A) v"]


def test_letters_and_positions(one):
    assert one(C.position_of, [" c ", "A"]) == [2, 0]
    assert one(C.position_or_minus_one, ["C", "1", "c", "AB", "A\n"]) == [2, -1, -1, -1, -1]


def test_choice_at_accepts_minus_one_and_out_of_range(spark):
    df = spark.createDataFrame([(["a", "b"], -1), (["a", "b"], 0), (["a", "b"], 7)], "c array<string>, p int")
    assert [r["x"] for r in df.select(C.choice_at("c", F.col("p")).alias("x")).collect()] == ["b", "a", None]


def test_four_choices_keep_the_right_answer(spark):
    df = rows_of(spark)
    before = {r.row_id: r.choices["ABCDE".index(r.answer)] for r in df.collect()}
    letters = set()
    for r in S.four_choices(df).collect():
        assert len(r.choices) == 4 == len(set(r.choices))
        assert r.choices["ABCD".index(r.answer)] == before[r.row_id]
        letters.add(r.answer)
    assert letters == set("ABCD")


def test_four_choices_leave_unusable_rows(spark):
    rows = [(1, ["a", "b", "c"], "A"), (2, ["a", "b", "c", "d"], "E")]
    df = spark.createDataFrame(rows, "row_id bigint, choices array<string>, answer string")
    assert [(r.row_id, r.choices, r.answer) for r in S.four_choices(df).orderBy("row_id").collect()] == rows


def test_shuffle_is_a_permutation_and_reproducible(spark):
    df = rows_of(spark, 50)
    once = df.select("row_id", C.shuffled("choices", 1, "row_id").alias("c")).collect()
    again = df.repartition(7).select("row_id", C.shuffled("choices", 1, "row_id").alias("c")).collect()
    assert sorted(map(str, once)) == sorted(map(str, again))
    assert all(sorted(r.c) == [f"c{r.row_id}-{k}" for k in range(5)] for r in once)
    other = df.select("row_id", C.shuffled("choices", 2, "row_id").alias("c")).collect()
    assert sorted(map(str, once)) != sorted(map(str, other))


def test_duplicate_choices_take_the_first_index(spark):
    df = spark.createDataFrame([(1, "q", "x", "x", "y", "x", "s")],
                               "row_id int, question string, distractor1 string, distractor2 string, distractor3 string, correct_answer string, support string")
    row = S.from_sciq(df).first()
    assert "ABCD".index(row.answer) == row.choices.index("x")


def test_prompts(spark):
    df = spark.createDataFrame([(" q ", ["a", "b"], "b", " r "), ("q", ["a", "b"], "C", None)],
                               "q string, c array<string>, a string, r string")
    first, second = df.select(
        P.quiz_prompt("q", "c").alias("p"), P.quiz_completion("c", "a", "r").alias("qc"),
        P.plain_prompt("q", "c").alias("pp"), P.plain_completion("c", "a", "r").alias("pc"),
        P.rationale_request("q", "c", "a").alias("rr"),
    ).collect()
    assert first.p.endswith("knowledge.\n\nQuestion: q\n A. a\n B. b\n\nAnswer:")
    assert first.qc == " B. b\nExplanation: r"
    assert first.pp == "Question:  q \nChoices:\nA. a\nB. b\nAnswer:"
    assert first.pc == "b. b\nExplanation:  r "
    assert second.pc == "C\nExplanation: "
    assert first.rr == "Question:  q \nChoices:\nA) a\nB) b\nAnswer: b\nExplanation:"
