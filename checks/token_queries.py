"""Token counts, masks, padding, passages."""

from pyspark.sql import functions as F

from millrace.functions import rules as R
from millrace.functions import tokens as T
from millrace.functions.prompts import quiz_completion, quiz_prompt
from millrace.operators import order as O
from millrace.operators.filtering import within_budget
from millrace.operators import sequences as Q
from millrace.plans.quantised import quantised_sequences
from millrace.plans.retrieval import retrieve, searchable_passages

from .base import TOKENS, key, query, table, tokens, view
from .choice_queries import PLAIN_PROMPT, QUIZ_COMPLETION, QUIZ_PROMPT


def joined(name):
    return F.btrim(F.to_json(name), F.lit("[]")).alias(name)


def ids(value):
    return f"list_transform(regexp_extract_all({value}, '{TOKENS}'), lambda t: ('0x' || substr(md5(t), 1, 7))::INT)"


def text_of(value):
    return f"array_to_string({value}, ',')"


@query(f"SELECT doc_id, CAST({tokens('text')} AS INT) AS tokens FROM documents WHERE {tokens('text')} <= 512")
def token_budget(spark, sf):
    return within_budget(table(spark, sf, "documents", deal=True).select("doc_id", "text"), "text").select("doc_id", "tokens")


@query(f"""
    SELECT doc_id, CAST({tokens('text')} AS INT) AS tokens FROM documents
""")
def user_token_counter(spark, sf):
    import regex

    def factory():
        pattern = regex.compile(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]")
        return lambda texts: [len(pattern.findall(t)) for t in texts]

    counter = T.token_counter(factory)
    return table(spark, sf, "documents", deal=True).select("doc_id", counter("text").alias("tokens"))


@query(f"""
    WITH p AS (SELECT row_id, {QUIZ_PROMPT} AS prompt, {QUIZ_COMPLETION} AS completion FROM quiz)
    SELECT row_id, CAST({tokens('prompt')} + {tokens('completion')} + 1 AS INT) AS total FROM p
    WHERE {tokens('prompt')} + {tokens('completion')} + 1 <= 512
""", "quiz")
def total_length(spark, sf):
    rows = view(spark, sf, "quiz").select(
        "row_id", T.count_tokens(quiz_prompt("question", "choices")).alias("p"),
        T.count_tokens(quiz_completion("choices", "answer", "rationale")).alias("c"),
    )
    return rows.where(R.fits_total(F.col("p"), F.col("c"))).select("row_id", (F.col("p") + F.col("c") + 1).alias("total"))


WIDE_ROWS = 20_000  # rows with a long text that one task sorts

MASKED = f"""
    p AS (SELECT row_id, {ids(QUIZ_PROMPT)} AS a, {ids(QUIZ_COMPLETION)} AS b FROM quiz),
    m AS (SELECT row_id, list_slice(list_concat(a, b), 1, 384) AS ids,
                 list_slice(list_concat(list_transform(a, lambda x: -100), b), 1, 384) AS labels FROM p)"""


def masked(rows, *keep):
    texts = rows.select(
        "row_id", *keep, quiz_prompt("question", "choices").alias("a"),
        quiz_completion("choices", "answer", "rationale").alias("b"),
    )
    return Q.masked_token_sequences(texts, "a", "b").drop("a", "b")


@query(f"""
    WITH {MASKED.strip()}
    SELECT row_id, {text_of('ids')} AS input_ids, {text_of('labels')} AS labels,
           {text_of('list_transform(ids, lambda x: 1)')} AS attention_mask FROM m
""", "quiz")
def mask_labels(spark, sf):
    return masked(view(spark, sf, "quiz")).select("row_id", joined("input_ids"), joined("labels"), joined("attention_mask"))


@query(f"""
    WITH {MASKED.strip()},
    n AS (SELECT *, (row_number() OVER (ORDER BY row_id) - 1) // 8 AS batch_id FROM m),
    w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM n)
    SELECT row_id, batch_id,
           {text_of('list_concat(ids, list_transform(range(longest - len(ids)), lambda x: 0))')} AS input_ids,
           {text_of('list_concat(labels, list_transform(range(longest - len(ids)), lambda x: -100))')} AS labels,
           {text_of('list_concat(list_transform(ids, lambda x: 1), list_transform(range(longest - len(ids)), lambda x: 0))')} AS attention_mask
    FROM w
""", "quiz")
def pad_batch(spark, sf):
    # numbered as texts, so that finding the ranks splits and hashes nothing; the quiz has the ids of mcq4
    order = O.number_order(view(spark, sf, "mcq4"), "row_id", most=WIDE_ROWS)
    batched = O.row_batches(view(spark, sf, "quiz"), order, size=8)
    return Q.pad_batches(masked(batched, "batch_id")).select(
        "row_id", "batch_id", joined("input_ids"), joined("labels"), joined("attention_mask")
    )


@query(f"""
    WITH t AS (SELECT row_id, {PLAIN_PROMPT} || chr(10) AS head,
                      answer || '. ' || choices[ord(answer) - 64] || chr(10) || 'Explanation: ' || rationale AS tail
               FROM quiz),
    p AS (SELECT row_id, {ids('head')} AS a, list_slice({ids('head || tail')}, 1, 512) AS b FROM t)
    SELECT row_id, {text_of('list_concat(b, list_transform(range(512 - len(b)), lambda x: 0))')} AS input_ids,
           {text_of('list_transform(list_concat(b, list_transform(range(512 - len(b)), lambda x: 0)), lambda x, i: CASE WHEN i <= len(a) THEN -100 ELSE x END)')} AS labels,
           {text_of('list_transform(range(512), lambda x: CASE WHEN x < len(b) THEN 1 ELSE 0 END)')} AS attention_mask
    FROM p
""", "quiz")
def quantised_training_rows(spark, sf):
    rows = quantised_sequences(view(spark, sf, "quiz"), "row_id")
    return rows.select("row_id", joined("input_ids"), joined("labels"), joined("attention_mask"))


CHUNKS = f"""
    t AS (SELECT doc_id, regexp_extract_all(text, '{TOKENS}') AS tokens FROM documents),
    c AS (SELECT doc_id, CAST(n AS INT) AS passage_no, array_to_string(list_slice(tokens, n * 512 + 1, n * 512 + 512), ' ') AS passage
          FROM (SELECT doc_id, tokens, unnest(range((len(tokens) + 511) // 512)) AS n FROM t))"""


@query(f"WITH {CHUNKS.strip()} SELECT doc_id, passage_no, passage FROM c")
def chunk_passages(spark, sf):
    docs = table(spark, sf, "documents", deal=True).select("doc_id", T.split_tokens("text").alias("tokens"))
    chunks = Q.chunk_passages(docs, "doc_id", "tokens")
    return chunks.select("doc_id", F.col("passage_no"), F.array_join("passage", " ").alias("passage"))


@query(f"WITH {CHUNKS.strip()} SELECT doc_id, passage_no, passage FROM c ORDER BY doc_id, passage_no LIMIT 777")
def bounded_passages(spark, sf):
    first = searchable_passages(table(spark, sf, "documents", deal=True), "doc_id", "text", most=777)
    return first.select("doc_id", "passage_no", F.array_join("passage", " ").alias("passage"))


@query(f"""
    WITH t AS (SELECT doc_id, regexp_extract_all(text, '{TOKENS}') AS tokens FROM documents),
    p AS (SELECT doc_id * 100000 + n AS passage_id, list_distinct(list_slice(tokens, n * 64 + 1, n * 64 + 64)) AS t
          FROM (SELECT doc_id, tokens, unnest(range((len(tokens) + 63) // 64)) AS n FROM t)),
    b AS (SELECT item_id, list_distinct(regexp_extract_all(text, '{TOKENS}')) AS t FROM benchmark),
    i AS (SELECT item_id, passage_id, len(list_intersect(p.t, b.t)) AS shared, len(p.t) + len(b.t) AS total FROM p CROSS JOIN b)
    SELECT item_id, passage_id, round(shared::DOUBLE / (total - shared), 6) AS score, CAST(1 AS INT) AS rank FROM i
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY shared::DOUBLE / (total - shared) DESC, passage_id) = 1
""")
def retrieval_end_to_end(spark, sf):
    """Documents cut into passages, and the best passage for every benchmark item."""
    passages = searchable_passages(table(spark, sf, "documents"), "doc_id", "text", size=64)
    passages = passages.withColumn("passage_id", F.col("doc_id") * 100000 + F.col("passage_no"))
    asked = table(spark, sf, "benchmark").select("item_id", T.split_tokens("text").alias("asked"))
    found = retrieve(passages, asked, "passage_id", "item_id", "passage", "asked", "jaccard", 1)
    return found.withColumn("score", F.round("score", 6))
