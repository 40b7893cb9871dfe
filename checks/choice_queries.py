"""Answer choices and prompts."""

from pyspark.sql import functions as F

from millrace.functions import choices as C
from millrace.functions import fixed_values as V
from millrace.functions import prompts as P
from millrace.operators.joins import attach_text
from millrace.operators.profile import answer_shares
from millrace.operators import shape as S

from .base import key, query, shuffled_sql, strip, sub, table, view

PREFIX = r"^(?:\([A-E]\)\*?|[A-E]\))+[\s]*"
STRIPPED = f"list_transform(choices, lambda o: {strip(sub('o', PREFIX))})"


def flat(column="choices"):
    return F.array_join(column, "|").alias("choices")


FLAT = "array_to_string(choices, '|') AS choices"


@query(f"SELECT row_id, array_to_string({STRIPPED}, '|') AS choices FROM mcq5", "mcq5")
def strip_choice_letters(spark, sf):
    return view(spark, sf, "mcq5").select("row_id", flat(C.strip_letter_prefixes("choices")))


@query(f"""
    WITH s AS (SELECT row_id, choices[ord(answer) - 64] AS correct, {shuffled_sql('42', 'row_id', 'choices')} AS choices FROM mcq5)
    SELECT row_id, {FLAT}, chr(CAST(64 + list_position(choices, correct) AS INT)) AS answer FROM s
""", "mcq5")
def choices_shuffle_remap(spark, sf):
    rows = view(spark, sf, "mcq5").withColumn("correct", C.choice_at("choices", C.position_of("answer")))
    mixed = rows.withColumn("choices", C.shuffled("choices", 42, "row_id"))
    return mixed.select("row_id", flat(), C.letter_of(C.index_in("choices", "correct")).alias("answer"))


OTHERS = "list_filter(choices, lambda c, i: i <> ord(answer) - 64)"
FOUR = shuffled_sql("42-order", "row_id", f"list_concat([choices[ord(answer) - 64]], list_slice({shuffled_sql('42', 'row_id', OTHERS)}, 1, 3))")


@query(f"""
    WITH s AS (SELECT row_id, answer, choices[ord(answer) - 64] AS correct, choices AS old,
                      CASE WHEN ord(answer) - 64 <= len(choices) AND len(choices) >= 4 THEN {FOUR} END AS new FROM mcq5)
    SELECT row_id, array_to_string(coalesce(new, old), '|') AS choices,
           CASE WHEN new IS NULL THEN answer ELSE chr(CAST(64 + list_position(new, correct) AS INT)) END AS answer
    FROM s
""", "mcq5")
def choices_five_to_four(spark, sf):
    return S.four_choices(view(spark, sf, "mcq5")).select("row_id", flat(), "answer")


@query(f"""
    WITH raw AS (SELECT row_id, question, choices[1] AS d1, choices[2] AS d2, choices[3] AS d3, choices[4] AS correct, rationale FROM quiz),
    s AS (SELECT *, {shuffled_sql('42', 'row_id', '[d1, d2, d3, correct]')} AS choices FROM raw)
    SELECT row_id, concat('sciq_', row_id) AS question_id, {FLAT},
           chr(CAST(64 + list_position(choices, correct) AS INT)) AS answer, coalesce(rationale, '') AS rationale, 'sciq' AS dataset
    FROM s
""", "quiz")
def convert_sciq(spark, sf):
    c = F.col("choices")
    raw = view(spark, sf, "quiz").select(
        "row_id", "question", c[0].alias("distractor1"), c[1].alias("distractor2"), c[2].alias("distractor3"),
        c[3].alias("correct_answer"), F.col("rationale").alias("support"),
    )
    return S.from_sciq(raw).select("row_id", "question_id", flat(), "answer", "rationale", "dataset")


@query(f"""
    SELECT row_id, concat('aqua_rat', row_id) AS question_id,
           array_to_string({STRIPPED}, '|') AS choices, answer,
           CASE WHEN contains(rationale, chr(10))
                THEN {strip("left(rationale, length(rationale) - strpos(reverse(rationale), chr(10)))")}
                ELSE rationale END || chr(10) || 'The answer is: ' || answer AS rationale
    FROM quiz
""", "quiz")
def convert_aqua(spark, sf):
    raw = view(spark, sf, "quiz").select(
        "row_id", "question", F.col("choices").alias("options"), "rationale", F.col("answer").alias("correct")
    )
    return S.from_aqua(raw).select("row_id", "question_id", flat(), "answer", "rationale")


def labelled(spark, sf):
    """Nested choices with labels; a third of the rows use digits as labels."""
    digits = F.array(*[F.lit(str(i)) for i in range(1, 6)])
    letters = F.array(*[F.lit(x) for x in "ABCDE"])
    numbered = F.col("row_id") % 3 == 1
    return view(spark, sf, "mcq5").select(
        "row_id", "split", "question", F.col("question").alias("question_stem"),
        F.struct(F.col("choices").alias("text"), F.when(numbered, digits).otherwise(letters).alias("label")).alias("choices"),
        F.when(numbered, (F.ascii("answer") - 64).cast("string")).otherwise(F.col("answer")).alias("answerKey"),
    )


CONVERTED = f"""
    WITH s AS (SELECT row_id, split, choices[ord(answer) - 64] AS correct, {FOUR} AS choices FROM mcq5)
    SELECT row_id, {{question_id}} AS question_id, {FLAT}, chr(CAST(64 + list_position(choices, correct) AS INT)) AS answer FROM s
"""


@query(CONVERTED.replace("{question_id}", "concat('ai2_arc_challenge_', row_id)"), "mcq5")
def convert_arc(spark, sf):
    return S.from_arc(labelled(spark, sf)).select("row_id", "question_id", flat(), "answer")


@query(CONVERTED.replace("{question_id}", "concat(split, '_', row_id)"), "mcq5")
def convert_openbook(spark, sf):
    return S.from_openbook(labelled(spark, sf)).select("row_id", "question_id", flat(), "answer")


@query(f"""
    WITH ok AS (SELECT *, CAST(cop AS INT) AS pos FROM mcq5
                WHERE choice_type = 'single' AND regexp_full_match(cop, '[0-3]')),
    s AS (SELECT row_id, subject_name, choices[pos + 1] AS correct, {shuffled_sql('42', 'row_id', 'choices[1:4]')} AS choices FROM ok)
    SELECT row_id, concat('medmcqa_', row_id) AS question_id, {FLAT},
           chr(CAST(64 + list_position(choices, correct) AS INT)) AS answer, subject_name FROM s
""", "mcq5")
def convert_medmcqa(spark, sf):
    from millrace.functions.rules import is_single_choice

    c = F.col("choices")
    raw = view(spark, sf, "mcq5").where(is_single_choice("choice_type", "cop")).select(
        "row_id", "question", *[c[i].alias(n) for i, n in enumerate(("opa", "opb", "opc", "opd"))],
        "cop", F.lit("").alias("exp"), "subject_name",
    )
    return S.from_medmcqa(raw).select("row_id", "question_id", flat(), "answer", "subject_name")


@query("""
    WITH a AS (SELECT split, count(*) AS total FROM mcq4 GROUP BY split),
    l AS (SELECT unnest(['A', 'B', 'C', 'D']) AS answer),
    c AS (SELECT split, answer, count(*) AS n FROM mcq4 GROUP BY split, answer)
    SELECT split, answer, coalesce(n, 0) AS rows, round(100.0 * coalesce(n, 0) / total, 6) AS percent
    FROM a CROSS JOIN l LEFT JOIN c USING (split, answer)
""", "mcq4")
def answer_distribution(spark, sf):
    return answer_shares(view(spark, sf, "mcq4")).withColumn("percent", F.round("percent", 6))


@query("""
    SELECT split, answer, count(*) AS rows,
           round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS percent
    FROM mcq5 GROUP BY split, answer
""", "mcq5")
def answer_distribution_present(spark, sf):
    return answer_shares(view(spark, sf, "mcq5"), letters=None).withColumn("percent", F.round("percent", 6))


LINES = "array_to_string(list_transform({c}, lambda c, i: concat({before}, chr(CAST(64 + i AS INT)), {after}, c{end})), {glue})"
QUIZ_LINES = LINES.format(c="choices[1:4]", before="' '", after="'. '", end=", chr(10)", glue="''")
PLAIN_LINES = LINES.format(c="choices", before="''", after="'. '", end="", glue="chr(10)")
ASK_LINES = LINES.format(c="choices", before="''", after="') '", end="", glue="chr(10)")
PREAMBLE = "'The following are multiple-choice questions (with answers) about advanced STEM knowledge.' || chr(10) || chr(10)"
QUIZ_PROMPT = f"{PREAMBLE} || 'Question: ' || {strip('question')} || chr(10) || {QUIZ_LINES} || chr(10) || 'Answer:'"
QUIZ_COMPLETION = f"' ' || answer || '. ' || choices[ord(answer) - 64] || chr(10) || 'Explanation: ' || {strip('rationale')}"
PLAIN_PROMPT = f"'Question: ' || question || chr(10) || 'Choices:' || chr(10) || {PLAIN_LINES} || chr(10) || 'Answer:'"


@query(f"SELECT row_id, {QUIZ_PROMPT} AS prompt, {QUIZ_COMPLETION} AS completion FROM quiz", "quiz")
def prompt_completion(spark, sf):
    return view(spark, sf, "quiz").select(
        "row_id", P.quiz_prompt("question", "choices").alias("prompt"),
        P.quiz_completion("choices", "answer", "rationale").alias("completion"),
    )


@query(f"""
    WITH q AS (SELECT m.row_id, m.question, m.choices[1:3] AS choices, m.answer, r.rationale
               FROM mcq5 m LEFT JOIN rationales r USING (row_id))
    SELECT row_id, {PLAIN_PROMPT} AS prompt,
           answer || CASE WHEN ord(answer) - 64 <= 3 THEN '. ' || choices[ord(answer) - 64] ELSE '' END
           || chr(10) || 'Explanation: ' || coalesce(rationale, '') AS completion
    FROM q
""", "mcq5 rationales")
def prompt_completion_quant(spark, sf):
    rows = view(spark, sf, "mcq5").withColumn("choices", F.slice("choices", 1, 3)).join(
        view(spark, sf, "rationales").select("row_id", "rationale"), "row_id", "left"
    )
    return rows.select(
        "row_id", P.plain_prompt("question", "choices").alias("prompt"),
        P.plain_completion("choices", "answer", "rationale").alias("completion"),
    )


@query(f"""
    SELECT row_id, 'Question: ' || question || chr(10) || 'Choices:' || chr(10) || {ASK_LINES}
           || chr(10) || 'Answer: ' || answer || chr(10) || 'Explanation:' AS request FROM mcq4
""", "mcq4")
def question_block(spark, sf):
    return view(spark, sf, "mcq4").select(
        "row_id", P.rationale_request("question", "choices", "answer").alias("request")
    )


def quoted(text):
    return "'" + text.replace("'", "''") + "'"


@query(f"""
    SELECT row_id, {quoted(V.VERIFY_HEAD)} || rationale || {quoted(V.VERIFY_MIDDLE)} || trim(rationale) || {quoted(V.VERIFY_TAIL)} AS request
    FROM rationales
""", "rationales")
def verify_prompt(spark, sf):
    return view(spark, sf, "rationales").select(
        "row_id", P.verification_request("rationale", F.trim("rationale")).alias("request")
    )


@query("""
    SELECT m.row_id, m.answer, m.split, coalesce(t.rationale, '') AS rationale
    FROM mcq4 m LEFT JOIN (SELECT row_id, rationale FROM rationales WHERE lang <> 'fr') t USING (row_id)
""", "mcq4 rationales")
def attach_rationale(spark, sf):
    written = view(spark, sf, "rationales").where("lang <> 'fr'").select(F.col("row_id").alias("id"), "rationale")
    rows = view(spark, sf, "mcq4").select("row_id", "answer", "split")
    return attach_text(rows, written, "row_id", "id", "rationale")


@query("""
    SELECT row_id, 'Q' || row_id AS question_id, CAST(length(question) AS INT) AS chars, 'part' AS dataset FROM mcq5
""", "mcq5")
def fields_and_tags(spark, sf):
    rows = S.tag_source(view(spark, sf, "mcq5"), "part").withColumns(
        {"question_id": S.prefixed_id("Q", "row_id"), "chars": F.length("question")}
    )
    kept = S.retain_fields(rows, ["row_id", "question_id", "chars", "dataset", "absent", "split"])
    return S.drop_fields(kept, ["split", "absent"])
