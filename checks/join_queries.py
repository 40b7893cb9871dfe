"""Removing rows by a second table, and unions."""

from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.operators.dedup import keep_first
from millrace.operators.profile import card_lines, composition, dataset_card
from millrace.operators.shape import prefixed_id, union_sources
from millrace.plans.preference import preference_corpus

from .base import canonical, key, query, table, tokens, view, strip


@query(f"""
    WITH a AS (SELECT doc_id, lang, {canonical('text')} AS c FROM documents WHERE source IN ('src1', 'src3', 'src5', 'src7', 'src9', 'src11')),
    b AS (SELECT {canonical('text')} AS c FROM documents WHERE source NOT IN ('src1', 'src3', 'src5', 'src7', 'src9', 'src11'))
    SELECT doc_id, lang FROM a WHERE c NOT IN (SELECT c FROM b)
""")
def canonical_anti_join(spark, sf):
    docs = table(spark, sf, "documents", deal=True)
    odd = F.col("source").isin("src1", "src3", "src5", "src7", "src9", "src11")
    known = docs.where(~odd).select(F.col("text").alias("Problem"))
    return J.drop_known_questions(docs.where(odd), known, "text", "Problem").select("doc_id", "lang")


@query("""
    SELECT doc_id, lang FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
""")
def verdict_anti_join(spark, sf):
    verdicts = table(spark, sf, "labels").select(
        F.col("doc_id").alias("question_id"),
        F.when(F.col("toxic") == 1, "MISMATCH: a step was lost").otherwise("MATCH").alias("verdict"),
    )
    return J.drop_mismatches(table(spark, sf, "documents"), verdicts, "doc_id").select("doc_id", "lang")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, sf):
    return J.drop_rows(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id").select("doc_id", "source")


@query("""
    SELECT row_id, subject_name FROM mcq5
    WHERE subject_name IN (SELECT p_type FROM part GROUP BY p_type HAVING avg(p_size) > (SELECT avg(p_size) FROM part))
""", "mcq5")
def subject_semi_filter(spark, sf):
    part = table(spark, sf, "part")
    mean = part.agg(F.avg("p_size").alias("m")).scalar()
    large = part.groupBy("p_type").agg(F.avg("p_size").alias("size")).where(F.col("size") > mean)
    allowed = large.select(F.col("p_type").alias("subject_name"))
    return J.keep_members(view(spark, sf, "mcq5"), allowed, "subject_name").select("row_id", "subject_name")


@query("""
    SELECT 'documents' AS dataset, doc_id AS row_id, text, lang, NULL AS role FROM documents
    UNION ALL SELECT 'benchmark', item_id, text, NULL, NULL FROM benchmark
    UNION ALL SELECT 'conversations', conv_id * 100 + turn, text, NULL, role FROM conversations
""")
def union_sources_by_name(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "text", "lang", "n_chars")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("row_id"), "text")
    talks = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("row_id"), "role", "text"
    )
    tagged = [df.withColumn("dataset", F.lit(n)) for n, df in (("documents", docs), ("benchmark", items), ("conversations", talks))]
    return union_sources(tagged, drop=["n_chars"]).select("dataset", "row_id", "text", "lang", "role")


LAST = strip(f"list_extract(string_split({strip('prompt')}, chr(10) || chr(10)), -1)")
USABLE = f"""
    ready AS (SELECT row_id, dataset, concat(dataset, row_id) AS id,
                     CASE WHEN dataset = 'metamath'
                          THEN {strip(f"substr({LAST}, 10, greatest(0, strpos({LAST}, 'Answer:') - 10))")}
                          ELSE prompt END AS prompt, chosen, rejected
              FROM pairs),
    usable AS (SELECT * FROM ready
               WHERE {strip("coalesce(prompt, '')")} <> '' AND {strip("coalesce(chosen, '')")} <> '' AND {strip("coalesce(rejected, '')")} <> ''
                 AND {tokens(strip('prompt'))} <= 400
                 AND {tokens(strip('prompt'))} + greatest({tokens(strip('chosen'))}, {tokens(strip('rejected'))}) <= 800)"""
SPLIT = f"""{USABLE},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY {key('42', 'id')}) AS r,
                      count(*) OVER (PARTITION BY dataset) AS n FROM usable),
    split AS (SELECT id, dataset, prompt, chosen, rejected,
                     CASE WHEN r <= floor(n * 0.1::DOUBLE) THEN 'test'
                          WHEN r <= floor(n * 0.1::DOUBLE) * 2 THEN 'validation' ELSE 'train' END AS split
              FROM ranked)"""
WITH_SPLIT = "WITH " + SPLIT.strip()


def preferences(spark, sf):
    pairs = view(spark, sf, "pairs")
    return preference_corpus(pairs.where("dataset = 'metamath'"), pairs.where("dataset = 'codealpaca'"))


@query(f"WITH {USABLE.strip()} SELECT row_id, dataset, prompt FROM usable", "pairs")
def preference_filter(spark, sf):
    from millrace.functions.text import last_question
    from millrace.plans.preference import usable_pairs

    pairs = view(spark, sf, "pairs")
    prompt = F.when(F.col("dataset") == "metamath", last_question("prompt")).otherwise(F.col("prompt"))
    return usable_pairs(pairs.withColumn("prompt", prompt)).select("row_id", "dataset", "prompt")


@query(f"{WITH_SPLIT} SELECT id, dataset, prompt, chosen, rejected, split, {key('42', 'dataset', 'id')} AS shuffle_key FROM split", "pairs")
def preference_corpus_rows(spark, sf):
    return preferences(spark, sf).select("id", "dataset", "prompt", "chosen", "rejected", "split", "shuffle_key")


@query(f"""
    {WITH_SPLIT}
    SELECT coalesce(dataset, '(all)') AS dataset, coalesce(split, '(all)') AS split, count(*) AS rows,
           round(100.0 * count(*) / (SELECT count(*) FROM split), 6) AS percent
    FROM split GROUP BY GROUPING SETS ((dataset, split), (dataset), (split), ())
""", "pairs")
def preference_composition(spark, sf):
    return composition(preferences(spark, sf)).withColumn("percent", F.round("percent", 6))


@query("""
    WITH g AS (SELECT CASE WHEN conv_id % 2 = 0 THEN 'metamath' ELSE 'codealpaca' END AS dataset, role AS split FROM conversations),
    t AS (SELECT count(*) AS n FROM g),
    d AS (SELECT string_agg(l, chr(10) ORDER BY dataset) AS s FROM
          (SELECT dataset, printf('- **%s**: %,d samples (%.1f%%)', dataset, count(*), 100.0 * count(*) / (SELECT n FROM t)) AS l FROM g GROUP BY dataset)),
    s AS (SELECT string_agg(l, chr(10) ORDER BY split) AS s FROM
          (SELECT split, printf('- **%s**: %,d samples (%.1f%%)', split, count(*), 100.0 * count(*) / (SELECT n FROM t)) AS l FROM g GROUP BY split))
    SELECT '# Talks' || chr(10) || chr(10) || 'This dataset contains ' || printf('%,d', t.n) || ' samples.' || chr(10) || chr(10)
           || '## Dataset Composition' || chr(10) || chr(10) || d.s || chr(10) || chr(10)
           || '## Dataset Splits' || chr(10) || chr(10) || s.s || chr(10) AS card
    FROM t, d, s
""")
def composition_card(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.when(F.col("conv_id") % 2 == 0, "metamath").otherwise("codealpaca").alias("dataset"),
        F.col("role").alias("split"),
    )
    return dataset_card(rows, "Talks")


@query("""
    WITH t AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE text END AS text FROM documents)
    SELECT doc_id FROM t QUALIFY text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
""")
def keep_first_null_text(spark, sf):
    """A null text is equal to nothing: all its rows stay."""
    docs = table(spark, sf, "documents").withColumn("text", F.when(F.col("doc_id") % 5 != 0, F.col("text")))
    return keep_first(docs, F.md5("text"), "doc_id").select("doc_id")


@query("""
    WITH r AS (SELECT CASE WHEN conv_id % 2 = 0 THEN 'metamath' ELSE 'codealpaca' END AS dataset, role AS split FROM conversations),
    c AS (SELECT dataset, split, count(*) AS rows, grouping(dataset) AS d, grouping(split) AS s FROM r GROUP BY CUBE (dataset, split))
    SELECT CASE WHEN d + s = 2 THEN 'whole' WHEN s = 1 THEN 'source' WHEN d = 1 THEN 'split' ELSE 'part' END AS section,
           CASE WHEN d + s = 2 THEN '(all)' WHEN s = 1 THEN dataset WHEN d = 1 THEN split ELSE dataset || ' / ' || split END AS name,
           rows, round(100.0 * rows / (SELECT count(*) FROM r), 6) AS percent FROM c
""")
def composition_lines(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.when(F.col("conv_id") % 2 == 0, "metamath").otherwise("codealpaca").alias("dataset"),
        F.col("role").alias("split"),
    )
    return card_lines(rows).drop("line").withColumn("percent", F.round("percent", 6))
