"""Text functions."""

from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.keys import content_hash
from millrace.operators.dedup import keep_first
from millrace.operators.joins import is_changed
from millrace.operators.profile import changed_counts, distinct_values
from millrace.operators.shape import comparison_rows

from .base import SPACE, SPACE_SET, canonical, has, query, spaced, strip, sub, table, view


@query(f"""
    WITH d AS (SELECT doc_id, lang, md5({canonical('text')}) AS h,
                      {strip('coalesce(text, $$$$)')} <> '' AS has_text FROM documents),
    firsts AS (SELECT min(doc_id) AS doc_id FROM d WHERE has_text GROUP BY h)
    SELECT lang, count(*) AS docs FROM d JOIN firsts USING (doc_id) GROUP BY lang
""")
def canonical_dedup_count(spark, sf):
    docs = table(spark, sf, "documents", deal=True).where(~X.is_blank("text"))
    kept = keep_first(docs, F.md5(X.canonicalize("text")), "doc_id")
    return kept.groupBy("lang").agg(F.count("*").alias("docs"))


@query(f"""
    SELECT count(DISTINCT {canonical('text')}) AS canonical_texts FROM documents
""")
def distinct_canonical_texts(spark, sf):
    return distinct_values(table(spark, sf, "documents", deal=True), X.canonicalize("text"), "canonical_texts")


@query(f"""
    WITH d AS (SELECT *, row_number() OVER (PARTITION BY {spaced('text')} ORDER BY doc_id) AS n FROM documents)
    SELECT doc_id, lang, source, CAST(length(text) AS BIGINT) AS chars FROM d WHERE n = 1
""")
def keep_first_md5(spark, sf):
    kept = keep_first(table(spark, sf, "documents", deal=True), content_hash("text"), "doc_id")
    return kept.select("doc_id", "lang", "source", F.length("text").cast("bigint").alias("chars"))


@query(f"SELECT doc_id, {canonical('text')} AS canonical FROM documents")
def canonical_text(spark, sf):
    return table(spark, sf, "documents", deal=True).select("doc_id", X.canonicalize("text").alias("canonical"))


@query(f"""
    SELECT row_id, CASE WHEN contains(rationale, chr(10))
                        THEN {strip("left(rationale, length(rationale) - strpos(reverse(rationale), chr(10)))")}
                        ELSE rationale END || chr(10) || 'The answer is: ' || answer AS rationale
    FROM rationales
""", "rationales")
def drop_last_line(spark, sf):
    return view(spark, sf, "rationales").select(
        "row_id", X.append_answer("rationale", "answer").alias("rationale")
    )


V1 = strip(
    "regexp_replace(regexp_replace(regexp_replace(rationale,"
    f" concat('(?i)[\\-=~>]*{SPACE}*the{SPACE}+correct{SPACE}+answer{SPACE}+is{SPACE}+', answer), '', 'g'),"
    f" concat('(?i)(answer|correct answer){SPACE}*:{SPACE}*', answer), '', 'g'),"
    f" concat('(?i)the answer is{SPACE}*:{SPACE}*', answer), '', 'g')"
)
V2 = strip(f"regexp_replace(rationale, concat('Ans{SPACE}+', answer, '\\.?{SPACE}*(?:\\r?\\n)?'), '', 'g')")


@query(f"SELECT row_id, {V1} AS rationale FROM rationales", "rationales")
def strip_answer_v1(spark, sf):
    return view(spark, sf, "rationales").select(
        "row_id", X.strip_answer_statements("rationale", "answer").alias("rationale")
    )


@query(f"SELECT row_id, {V2} AS rationale FROM rationales", "rationales")
def strip_answer_v2(spark, sf):
    return view(spark, sf, "rationales").select(
        "row_id", X.strip_ans_letter("rationale", "answer").alias("rationale")
    )


@query(f"""
    SELECT row_id,
           translate({sub('rationale', f'(?i)^(solution|sol[.]?|explanation|expl){SPACE}*:?{SPACE}*[.]?{SPACE}*')}, '–—', '--') AS solution_free,
           {sub('rationale', f'(?i)^(exp(l(anation)?)?[.]?){SPACE}*:{SPACE}*')} AS explanation_free
    FROM rationales
""", "rationales")
def strip_prefixes(spark, sf):
    return view(spark, sf, "rationales").select(
        "row_id",
        X.normalize_dashes(X.strip_solution_prefix("rationale")).alias("solution_free"),
        X.strip_explanation_prefix("rationale").alias("explanation_free"),
    )


LEADING = (
    rf"(?i)^ans(?:wer)?[.]?{SPACE}*(is)?{SPACE}*[:=]?{SPACE}*[(\['']?[a-d][)\]'']?"
    rf"(?:[.]|:)?(?:{SPACE}*i[.]?e[.]?|,)?{SPACE}*"
)
MENTION = strip(sub(strip(sub("rationale", LEADING)), rf"^[.,;:\-{SPACE_SET}]+"))


@query(f"SELECT row_id, {MENTION} AS rationale FROM rationales", "rationales")
def remove_answer_mention(spark, sf):
    return view(spark, sf, "rationales").select(
        "row_id", X.remove_answer_mention("rationale").alias("rationale")
    )


@query(f"""
    SELECT split, count(*) AS rows,
           CAST(count(*) FILTER ({strip('rationale')} <> {V1}) AS BIGINT) AS rows_changed
    FROM rationales GROUP BY split
""", "rationales")
def changed_by_cleaning(spark, sf):
    rows = view(spark, sf, "rationales")
    return changed_counts(rows, "rationale", X.strip_answer_statements("rationale", "answer"))


@query(f"""
    SELECT row_id AS question_id, rationale AS original, {V2} AS cleaned
    FROM rationales WHERE {strip('rationale')} <> {V2}
""", "rationales")
def before_after_rows(spark, sf):
    rows = view(spark, sf, "rationales").withColumn("clean", X.strip_ans_letter("rationale", "answer"))
    return comparison_rows(rows.where(is_changed("rationale", "clean")), "row_id", "rationale", "clean")


@query("""
    SELECT doc_id, replace(replace(text, '"', ''''), chr(10), ' ') AS one_line,
           split_part(text, '. ', -1) AS tail,
           CAST(strpos(text, 'the') AS BIGINT) AS first_the, replace(replace(upper(text), 'ß', 'SS'), 'ẞ', 'SS') AS shout
    FROM documents
""")
def quotes_and_pieces(spark, sf):
    return table(spark, sf, "documents", deal=True).select(
        "doc_id",
        X.soften_quotes("text", newlines=True).alias("one_line"),
        X.after_last("text", ". ").alias("tail"),
        F.locate("the", "text").cast("bigint").alias("first_the"),
        F.upper("text").alias("shout"),
    )


@query(f"""
    WITH p AS (SELECT row_id, dataset, prompt, {strip(f"list_extract(string_split({strip('prompt')}, chr(10) || chr(10)), -1)")} AS last
               FROM pairs)
    SELECT row_id, dataset,
           CASE WHEN prompt IS NULL OR prompt = '' THEN prompt
                WHEN NOT contains(last, 'Question:') THEN last
                WHEN contains(last, 'Answer:')
                     THEN {strip("substr(last, strpos(last, 'Question:') + 9, greatest(0, strpos(last, 'Answer:') - strpos(last, 'Question:') - 9))")}
                ELSE {strip("substr(last, strpos(last, 'Question:') + 9)")} END AS prompt
    FROM p
""", "pairs")
def last_paragraph_question(spark, sf):
    return view(spark, sf, "pairs").select("row_id", "dataset", X.last_question("prompt").alias("prompt"))
