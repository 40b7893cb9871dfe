from pyspark.sql import functions as F

from millrace.functions import tokens as T
from millrace.operators import sequences as Q

from __spark_entry__ import queries

from .conftest import SMALL


def test_masked_sequences(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], [4, 5]), (2, [1] * 6, [9]), (3, [], [7])], "id int, p array<int>, c array<int>")
    found = {r.id: (r.input_ids, r.labels, r.attention_mask) for r in Q.masked_sequences(df, "p", "c", 4).collect()}
    assert found == {
        1: ([1, 2, 3, 4], [-100, -100, -100, 4], [1] * 4), 2: ([1] * 4, [-100] * 4, [1] * 4), 3: ([7], [7], [1]),
    }


def test_padded_sequences_keep_padding_in_labels(spark):
    df = spark.createDataFrame([(1, [1, 2], [1, 2, 3]), (2, [1] * 9, [1] * 9)], "id int, p array<int>, f array<int>")
    found = {r.id: (r.input_ids, r.labels, r.attention_mask) for r in Q.padded_sequences(df, "p", "f", 5, fill=8).collect()}
    assert found == {
        1: ([1, 2, 3, 8, 8], [-100, -100, 3, 8, 8], [1, 1, 1, 0, 0]), 2: ([1] * 5, [-100] * 5, [1] * 5),
    }


def test_batches_pad_to_their_longest(spark):
    df = spark.createDataFrame([(0, [1], [1], [1]), (0, [1, 2, 3], [1, 2, 3], [1, 1, 1]), (1, [4], [4], [1])],
                               "batch_id int, input_ids array<int>, labels array<int>, attention_mask array<int>")
    found = sorted((r.batch_id, r.input_ids, r.labels, r.attention_mask) for r in Q.pad_batches(df, fill=9).collect())
    assert found == [(0, [1, 2, 3], [1, 2, 3], [1, 1, 1]), (0, [1, 9, 9], [1, -100, -100], [1, 0, 0]), (1, [4], [4], [1])]


def test_passages_cover_every_token(spark):
    df = spark.createDataFrame([(i, [str(k) for k in range(i)]) for i in range(12)], "id bigint, tokens array<string>")
    found = {}
    for r in Q.chunk_passages(df, "id", "tokens", 4).orderBy("id", "passage_no").collect():
        found.setdefault(r.id, []).extend(r.passage)
        assert 1 <= len(r.passage) <= 4
    assert found == {i: [str(k) for k in range(i)] for i in range(1, 12)}


def test_first_passages_for_every_limit(spark):
    df = spark.createDataFrame([(i * 10, " ".join("w" * (i % 5 * 3))) for i in range(12)], "id bigint, t string")
    whole = [(r.id, r.passage_no) for r in Q.first_passages(df, "id", "t", 4, 1000).orderBy("id", "passage_no").collect()]
    assert len(whole) == sum(-(-(i % 5 * 3) // 4) for i in range(12))
    for most in (0, 1, 5, len(whole)):
        found = Q.first_passages(df, "id", "t", 4, most).select("id", "passage_no").collect()
        assert sorted(map(tuple, found)) == whole[:most]


def test_hashed_text_equals_split_and_hashed_tokens(spark):
    texts = [None, "", " \t", "Ab_1 c.d  é漢字x!", "\U000323afࡰa 𝔘², ٣٤", "a" * 70 + "-b", "x y z"] * 3 + ["\x85 a\x1cb　"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").coalesce(1)
    old = df.select("id", T.hashed_ids(T.split_tokens("t")).alias("ids"))
    wanted = {r.id: r.ids for r in old.collect()}
    for most in (None, 0, 3):
        found = {r.id: r.n for r in df.select("id", T.hashed_text("t", most).alias("n")).collect()}
        for i, ids in wanted.items():
            assert (found[i] is None) == (ids is None)
            assert ids is None or (found[i].ids, found[i].size) == (ids[:most], len(ids))


def test_masked_texts_equal_masked_token_lists(spark):
    rows = [(1, "a b c", "d e"), (2, "a b c d e f g", "h"), (3, "", "x y z u v w"), (4, None, "x"), (5, "x", None)]
    df = spark.createDataFrame(rows, "id int, p string, c string")
    lists = df.select("id", T.split_tokens("p").alias("p"), T.split_tokens("c").alias("c"))
    for end in (None, 7):
        found, wanted = (
            sorted(Q.masked_token_sequences(d, "p", "c", limit=5, end_id=end).drop("p", "c").collect()) for d in (df, lists))
        assert found == wanted and [r.dropped for r in found[:2]] == [0 + (end is not None), 3 + (end is not None)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_token_queries_hash_in_batches_and_number_rows_before(spark):
    for name in ("mask_labels", "pad_batch", "quantised_training_rows"):
        plan = plan_of(queries()[name](spark, SMALL))
        assert "md5(" not in plan and "regexp_extract_all" not in plan, name
        assert plan.count("ArrowEvalPython") == 1, name
