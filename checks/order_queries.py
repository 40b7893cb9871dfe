"""Order, sampling, splits, balancing, mixing."""

from pyspark.sql import functions as F

from millrace.functions.keys import hash_key
from millrace.operators import order as O
from millrace.operators import sampling as W
from millrace.operators import splits as P

from .base import key, query, table, view


@query(f"SELECT doc_id, row_number() OVER (ORDER BY {key('42', 'doc_id')}) AS rank FROM documents")
def seeded_shuffle_rank(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return O.with_rank(docs, O.hash_order("doc_id")).select("doc_id", "rank")


@query("SELECT doc_id, lang FROM documents")
def seeded_shuffle(spark, sf):
    return O.seeded_shuffle(table(spark, sf, "documents"), "doc_id").select("doc_id", "lang")


@query(f"SELECT doc_id, text FROM documents ORDER BY {key('42', 'doc_id')} LIMIT 150")
def sample_n(spark, sf):
    return O.sample_rows(table(spark, sf, "documents"), "doc_id", 150).select("doc_id", "text")


@query(f"""
    WITH r AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY role ORDER BY {key('7', 'conv_id * 100 + turn')}) AS n FROM conversations)
    SELECT conv_id, turn, role FROM r WHERE n <= 100
""")
def sample_n_per_group(spark, sf):
    talks = table(spark, sf, "conversations").withColumn("id", F.col("conv_id") * 100 + F.col("turn"))
    return O.sample_rows(talks, "id", 100, seed=7, group=["role"]).select("conv_id", "turn", "role")


@query(f"""
    WITH t AS (SELECT row_id, row_number() OVER (ORDER BY {key('42', 'row_id')}) AS r FROM rationales WHERE split = 'train')
    SELECT row_id, CASE WHEN t.r <= 100 THEN 'validation' ELSE split END AS split FROM rationales LEFT JOIN t USING (row_id)
""", "rationales")
def holdout_exact(spark, sf):
    return P.holdout(view(spark, sf, "rationales"), "row_id", 100).select("row_id", "split")


@query(f"""
    WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {key('42', 'doc_id')}) AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents)
    SELECT doc_id, lang, CASE WHEN r <= floor(n * 0.1::DOUBLE) THEN 'test' WHEN r <= 2 * floor(n * 0.1::DOUBLE) THEN 'validation' ELSE 'train' END AS split FROM r
""")
def three_way_split(spark, sf):
    return P.three_way_split(table(spark, sf, "documents"), "doc_id", group=["lang"]).select("doc_id", "lang", "split")


@query(f"""
    WITH t AS (SELECT row_id, row_number() OVER (ORDER BY {key('42', 'row_id')}) AS r, count(*) OVER () AS n FROM mcq5 WHERE split = 'train')
    SELECT row_id, CASE WHEN t.r <= floor(n * 0.08::DOUBLE) THEN 'validation' ELSE split END AS split FROM mcq5 LEFT JOIN t USING (row_id)
""", "mcq5")
def validation_topup(spark, sf):
    return P.top_up_validation(view(spark, sf, "mcq5"), "row_id").select("row_id", "split")


@query(f"SELECT doc_id, lang FROM documents WHERE substr({key('42', 'doc_id')}, 1, 8) < '26666666'")
def hash_fraction(spark, sf):
    return P.random_fraction(table(spark, sf, "documents"), "doc_id", 0.15).select("doc_id", "lang")


@query("""
    SELECT conv_id, turn, (row_number() OVER (ORDER BY conv_id * 100 + turn) - 1) // 25 AS batch_id FROM conversations
""")
def batch_ids(spark, sf):
    talks = table(spark, sf, "conversations").withColumn("id", F.col("conv_id") * 100 + F.col("turn"))
    return O.row_batches(talks, O.number_order(talks, "id")).select("conv_id", "turn", "batch_id")


@query("SELECT row_id, split, row_number() OVER (PARTITION BY split ORDER BY row_id) - 1 AS row_index FROM mcq5", "mcq5")
def dense_row_id(spark, sf):
    rows = view(spark, sf, "mcq5").select("row_id", "split")
    return O.row_index(rows, O.number_order(rows, "row_id"), ["split"])


@query("SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id DESC LIMIT 1")
def head_sample(spark, sf):
    return O.head_rows(table(spark, sf, "documents"), "doc_id", last=True).select("doc_id", "lang", "source", "n_chars")


@query(f"""
    WITH w AS (SELECT row_id, {key('42', 'row_id')} AS k,
                      CASE subject_name WHEN 'PROMO' THEN 10 WHEN 'SMALL' THEN 4 WHEN 'LARGE' THEN 7 WHEN 'ECONOMY' THEN 1 END AS w FROM mcq5),
    line AS (SELECT row_id, w, CAST(sum(w) OVER (ORDER BY k) AS BIGINT) AS hi, CAST(sum(w) OVER () AS BIGINT) AS total FROM w WHERE w IS NOT NULL),
    draws AS (SELECT ('0x' || substr({key('42-draw', 'row_id')}, 1, 15))::BIGINT % total AS u FROM line),
    hits AS (SELECT l.row_id, count(*) AS n FROM draws d JOIN line l ON d.u >= l.hi - l.w AND d.u < l.hi GROUP BY l.row_id)
    SELECT row_id, subject_name, copy FROM (SELECT row_id, unnest(range(1, n + 1)) AS copy FROM hits) JOIN mcq5 USING (row_id)
""", "mcq5")
def weighted_resample(spark, sf):
    rows = view(spark, sf, "mcq5").withColumn(
        "w", W.weight_of("subject_name", {"PROMO": 0.10, "SMALL": 0.04, "LARGE": 0.07, "ECONOMY": 0.01})
    )
    return W.weighted_resample(rows, "row_id", "w").select("row_id", "subject_name", "copy")


@query("""
    WITH w AS (SELECT row_id, subject_name, CASE subject_name WHEN 'PROMO' THEN 10 WHEN 'SMALL' THEN 4 WHEN 'LARGE' THEN 7 WHEN 'ECONOMY' THEN 1 END AS w FROM mcq5)
    SELECT subject_name, round(sum(w) * 1.0 / (SELECT sum(w) FROM w), 9) AS probability FROM w WHERE w IS NOT NULL GROUP BY subject_name
""", "mcq5")
def subject_probabilities(spark, sf):
    rows = view(spark, sf, "mcq5").withColumn(
        "w", W.weight_of("subject_name", {"PROMO": 0.10, "SMALL": 0.04, "LARGE": 0.07, "ECONOMY": 0.01})
    ).where("w is not null")
    per_row = W.with_probability(rows, "w").groupBy("subject_name").agg(F.sum("probability").alias("p"))
    return per_row.select("subject_name", F.round("p", 9).alias("probability"))


@query(f"""
    WITH s AS (SELECT doc_id, lang, CASE lang WHEN 'en' THEN 0.4::DOUBLE WHEN 'fr' THEN 0.3::DOUBLE WHEN 'de' THEN 0.2::DOUBLE WHEN 'es' THEN 0.1::DOUBLE END AS p,
                      count(*) OVER (PARTITION BY lang) AS n, row_number() OVER (PARTITION BY lang ORDER BY {key('42', 'doc_id')}) AS r FROM documents),
    q AS (SELECT *, CAST(floor((SELECT max(ceil(n / p)) FROM s) * p + 0.5) AS BIGINT) AS quota FROM s),
    c AS (SELECT doc_id, lang, unnest(range(1, quota // n + CASE WHEN r <= quota % n THEN 2 ELSE 1 END)) AS copy FROM q)
    SELECT doc_id, lang, copy, {key('42-mix', 'lang', 'doc_id', 'copy')} AS mix_key FROM c
""")
def quota_interleave(spark, sf):
    mixed = W.mix_sources(
        table(spark, sf, "documents"), "doc_id", {"en": 0.4, "fr": 0.3, "de": 0.2, "es": 0.1}, source="lang"
    )
    return mixed.select("doc_id", "lang", "copy", W.mix_order("doc_id", "lang").alias("mix_key"))
