import pytest
from pyspark.sql import functions as F

from millrace.functions import rules as R
from millrace.functions.tokens import count_tokens
from millrace.operators import filtering


def test_loose_urls_and_figures(one):
    assert one(R.has_loose_url, ["http : //x", "HTTPS://y", "www .z", "what", None]) == [True, True, True, False, False]
    assert one(R.has_figure_reference, [
        "See Figure 2", "as  shown in\nfigure", "oversee Figure", "refer to Figures", "figure 1", None,
    ]) == [True, True, False, False, False, False]


def test_citations(one):
    texts = [
        "Ref: x", "refer to", "reference", "prefer", "Chapter 12", "p. 33", "pages4", "top 4", "volume 3",
        "17th edition", "2/e", "2e", "117th edition", "https://a", "www.a", "GRAYS anatomy", "grayscale", "éref", None,
    ]
    assert one(R.cites_reference, texts) == [
        True, True, False, False, True, True, True, False, True,
        True, True, True, False, True, True, True, False, False, False,
    ]


@pytest.mark.parametrize("text, allowed", [
    ("plain ASCII \x7f", True), ("π θ ∴ → € ", True), ("café", True), ("É", False), ("日", False),
    ("Ω", True), ("Ω", False), ("ʹ", True), ("✙", True), ("\U0001f7a1", True), ("ᵝ", False),
    ("é ", False), ("“quoted”", True), ("–", False), ("", True),
])
def test_allowed_characters(one, text, allowed):
    assert one(R.has_only_allowed_characters, [text]) == [allowed]


def test_short_rationales(one):
    assert one(R.is_long_or_valid_short, [
        "x" * 27, "short one", "tiny", "  padded   ", "the Option A", "is correct", None,
    ]) == [True, True, False, False, False, False, False]


def test_single_choice(one):
    kinds = ["single", "single", "multi", "single", "single", None, "single", "single"]
    answers = ["0", " 3 ", "1", "4", "x", "1", None, "-1"]
    assert one(lambda t, o: R.is_single_choice(o, t), answers, kinds) == [
        True, True, False, False, False, False, False, False,
    ]


def test_required_fields(spark):
    rows = [
        ("q", "r", "A", ["x", "y"]), (" ", "r", "A", ["x", "y"]), ("q", None, "A", ["x", "y"]),
        ("q", "r", "A", ["x"]), ("q", "r", "A", None),
    ]
    df = spark.createDataFrame(rows, "q string, r string, a string, o array<string>")
    found = df.select(R.has_required_fields("q", "r", "a", "o").alias("ok")).collect()
    assert [r["ok"] for r in found] == [True, False, False, False, False]


def test_complete_mcq(spark):
    rows = [
        ("q", ["a", "b", "c", "d"], "D"), ("q", ["a", "b", "c", ""], "A"), ("q", ["a", "b", "c"], "A"),
        ("", ["a", "b", "c", "d"], "A"), ("q", ["a", "b", "c", "d"], "E"), (None, ["a", "b", "c", "d"], "A"),
        ("q", ["a", None, "c", "d"], "A"),
    ]
    df = spark.createDataFrame(rows, "q string, c array<string>, a string")
    found = df.select(R.is_complete_mcq("q", "c", "a").alias("ok")).collect()
    assert [r["ok"] for r in found] == [True] + [False] * 6


def test_corpus_rule_literal_and_strict(one):
    long = "w " * 600
    texts = ["Q: x H: " + long, "Q: x A: " + long, "Q: x H: short", "Q: A: short", "pH: enough text here", long]
    literal = one(lambda t: R.keeps_in_corpus(t, count_tokens(t)), texts)
    strict = one(lambda t: R.keeps_in_corpus(t, count_tokens(t), strict=True), texts)
    assert literal == [False, True, False, False, True, True]
    assert strict == [False, False, False, False, True, False]


def test_preferences(one):
    prompts = ["p " * 400, "p " * 401, "p " * 400, " ", "p"]
    chosen = ["c " * 400, "c", "c " * 401, "c", None]
    rejected = ["r"] * 5
    found = one(lambda p, c, r: R.is_usable_preference(p, c, r, count_tokens), prompts, chosen, rejected)
    assert found == [True, False, False, False, False]


def test_url_rule_skips_arrays(spark):
    df = spark.createDataFrame([("a", ["http://x"]), ("see http://x", ["y"])], "t string, o array<string>")
    assert [r["u"] for r in df.select(R.url_in_any_string(df).alias("u")).collect()] == [False, True]


def test_partition_is_complete(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, t string")
    kept, rejected = filtering.partition_by_rule(df, F.col("t") == "a")
    assert {r.id for r in kept.collect()} == {1} and {r.id for r in rejected.collect()} == {2, 3}


def test_drop_shortest_matches_linear_percentile(spark):
    import numpy as np

    lengths = {"a": [3, 9, 1, 4, 4, 12, 30, 0, 7], "b": [5, 5, 5]}
    rows = [(s, "x" * n) for s, ns in lengths.items() for n in ns]
    df = spark.createDataFrame(rows, "split string, t string")
    kept = sorted((r.split, len(r.t)) for r in filtering.drop_shortest(df, "t").collect())
    expected = sorted(
        (s, n) for s, ns in lengths.items() for n in ns if n > np.percentile([m for m in ns if m], 10)
    )
    assert kept == expected


def test_texts_are_not_shuffled_by_their_group(spark):
    """Two groups: a shuffle by them would put most texts in one task."""
    df = spark.range(400).selectExpr("if(id % 9 = 0, null, 'train') AS split", "repeat('x', cast(id % 50 as int)) AS t")
    kept = filtering.drop_shortest(df, "t")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert 300 < kept.count() < 400
