"""Whole corpora."""

from pyspark.sql import functions as F

from millrace.operators import shape as S
from millrace.plans import quiz as Z
from millrace.plans import retrieval as R
from millrace.session import staged

from .base import SPACE, SPACE_SET, canonical, key, query, shuffled_sql, spaced, strip, sub, table, tokens, view
from .choice_queries import FOUR, QUIZ_COMPLETION, QUIZ_PROMPT, STRIPPED, flat, labelled
from .rule_queries import CITES, FIGURE, LOOSE, REFUSED, UNNAMED
from .text_queries import MENTION
from .vector_queries import lloyd_sql


def sciq_raw(spark, sf):
    c = F.col("choices")
    return view(spark, sf, "quiz").select(
        "row_id", "split", "question", c[0].alias("distractor1"), c[1].alias("distractor2"),
        c[2].alias("distractor3"), c[3].alias("correct_answer"), F.col("rationale").alias("support"),
    )


def selected_raw(spark, sf):
    """question, answer rows as the diversity selection writes them."""
    return view(spark, sf, "rationales").select(
        F.concat(F.lit("What does document "), F.col("row_id"), F.lit(" say?")).alias("question"),
        F.col("rationale").alias("answer"),
    )


TEMPLATES = f"""
    c AS (SELECT 'Example of related question Q and answer A: Q: ' || question || ' A: ' || rationale || chr(10) || 'The answer is ' || choices[4] AS text, 'allenai/sciq' AS source
          FROM quiz WHERE {strip('rationale')} <> ''
          UNION ALL SELECT 'Example of related question Q and hint H: Q: What does document ' || row_id || ' say? H: ' || rationale, 'qiaojin/PubMedQA' FROM rationales
          UNION ALL SELECT 'Example of related question Q and answer A: Q: ' || question || ' A: ' || CASE WHEN row_id % 3 = 1 THEN choices[5] ELSE choices[ord(answer) - 64] END, 'allenai/ai2_arc (ARC-Easy)' FROM mcq5 WHERE split <> 'train'
          UNION ALL SELECT 'Example of related question Q and answer A: Q: ' || question || ' A: ' || CASE WHEN row_id % 3 = 1 THEN choices[5] ELSE choices[ord(answer) - 64] END, 'allenai/ai2_arc (ARC-Challenge)' FROM mcq5 WHERE split = 'train'
          UNION ALL SELECT 'Example of related question Q and answer A: Q: What does document ' || row_id || ' say? A: ' || rationale, 'deepmind/aqua_rat' FROM rationales)"""


def sources(spark, sf):
    arc = labelled(spark, sf)
    selected = selected_raw(spark, sf)
    return (
        sciq_raw(spark, sf), selected, arc.where("split <> 'train'"), arc.where("split = 'train'"), selected
    )


@query(f"WITH {TEMPLATES.strip()} SELECT source, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS chars FROM c GROUP BY source", "quiz")
def corpus_templates(spark, sf):
    sciq, pubmed, easy, challenge, aqua = sources(spark, sf)
    texts = S.union_sources([
        S.sciq_passages(sciq.where(~F.col("support").rlike(r"\A\s*\z"))), S.hint_passages(pubmed), S.keyed_passages(easy, "allenai/ai2_arc (ARC-Easy)"),
        S.keyed_passages(challenge, "allenai/ai2_arc (ARC-Challenge)"), S.answer_passages(aqua),
    ])
    return texts.groupBy("source").agg(F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars"))


KEEP = f"""CASE WHEN contains(text, 'H: ') THEN {{limit}} AND length(split_part(text, 'H: ', -1)) >= 10
                ELSE {{other}} length(split_part(text, 'A: ', -1)) >= 10 END"""


@query(f"WITH {TEMPLATES.strip()} SELECT text, source FROM c WHERE {KEEP.format(limit=tokens('text') + ' <= 512', other='')}", "quiz")
def corpus_filter(spark, sf):
    return R.passage_corpus(*sources(spark, sf))


@query(f"WITH {TEMPLATES.strip()} SELECT text, source FROM c WHERE {tokens('text')} <= 512 AND {KEEP.format(limit='true', other='')}", "quiz")
def corpus_filter_strict(spark, sf):
    return R.passage_corpus(*sources(spark, sf), strict=True)


@query(f"""
    SELECT question, rationale AS context, 'allenai/sciq' AS source FROM quiz WHERE {strip('rationale')} <> ''
    UNION ALL SELECT 'What does document ' || row_id || ' say?', rationale, 'qiaojin/PubMedQA' FROM rationales
    UNION ALL SELECT question, CASE WHEN row_id % 3 = 1 THEN choices[5] ELSE choices[ord(answer) - 64] END,
                     CASE WHEN split = 'train' THEN 'allenai/ai2_arc (ARC-Challenge)' ELSE 'allenai/ai2_arc (ARC-Easy)' END FROM mcq5
    UNION ALL SELECT 'What does document ' || row_id || ' say?', rationale, 'deepmind/aqua_rat' FROM rationales
""", "quiz")
def training_pairs(spark, sf):
    return R.training_pairs(*sources(spark, sf))


@query(f"SELECT 'What does document ' || row_id || ' say?' AS question, rationale AS context FROM rationales WHERE {strip('rationale')} <> ''", "rationales")
def encoder_input(spark, sf):
    pairs = view(spark, sf, "rationales").select(
        "row_id", F.concat(F.lit("What does document "), F.col("row_id"), F.lit(" say?")).alias("question"),
        F.col("rationale").alias("context"),
    )
    return R.encoder_input(pairs, "row_id")


@query("SELECT 'TIGER-Lab/MMLU-Pro' AS id, question, array_to_string(choices, '|') AS choices, answer FROM mcq5", "mcq5")
def eval_format(spark, sf):
    raw = view(spark, sf, "mcq5").withColumnRenamed("choices", "options").select("question", "options", "answer")
    return S.evaluation_rows(raw).select("id", "question", flat(), "answer")




@query(f"""
    WITH p AS (SELECT a.conv_id, a.turn, replace(a.text, '"', '''') AS question,
                      replace(a.text || ' ' || coalesce(b.text, ''), '"', '''') AS answer
               FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
    t AS (SELECT conv_id * 100 + turn AS row_id, question, answer, 'Example of related question Q and hint H: Q:' || question || ' H: ' || answer AS text FROM p)
    SELECT row_id, question, answer, text FROM t WHERE {tokens('text')} <= 512
""")
def hint_candidates(spark, sf):
    talks = table(spark, sf, "conversations")
    following = talks.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    raw = talks.join(following, ["conv_id", "turn"], "left").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("row_id"), F.col("text").alias("question"),
        F.struct(F.array("text", F.coalesce("next", F.lit(""))).alias("contexts")).alias("context"),
    )
    return R.hint_candidates(raw)


@query(f"""
    WITH t AS (SELECT row_id, replace(replace(question, '"', ''''), chr(10), ' ') AS question,
                      replace(replace(rationale, '"', ''''), chr(10), ' ') AS answer FROM quiz WHERE NOT contains(rationale, 'Ans')),
    f AS (SELECT *, 'Example of related question Q and answer A: Q: ' || question || ' A: ' || answer AS text FROM t)
    SELECT row_id, question, answer, text FROM f WHERE {tokens('text')} <= 512
""", "quiz")
def answer_candidates(spark, sf):
    raw = view(spark, sf, "quiz").withColumn("was_cleaned", ~F.contains("rationale", F.lit("Ans")))
    return R.answer_candidates(raw)


WITH_TEXT = "(SELECT * FROM embeddings WHERE vec_id IN (SELECT row_id FROM rationales))"


@query(f"SELECT r.source AS question, r.rationale AS answer FROM ({lloyd_sql(20, 25, WITH_TEXT)}) p JOIN rationales r ON r.row_id = p.vec_id", "rationales")
def selected_examples(spark, sf):
    rows = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "row_id")
    texts = view(spark, sf, "rationales").select("row_id", F.col("source").alias("question"), F.col("rationale").alias("answer"))
    return R.selected_examples(rows.join(texts, "row_id"), k=20)


@query(f"""
    WITH s AS (SELECT row_id, split, question, choices[4] AS correct, rationale, {shuffled_sql('42', 'row_id', 'choices')} AS choices
               FROM quiz WHERE {strip('rationale')} <> '' AND NOT ({LOOSE} OR {FIGURE})),
    t AS (SELECT row_id, row_number() OVER (ORDER BY {key('42', 'row_id')}) AS r FROM s WHERE split = 'train')
    SELECT row_id, array_to_string(choices, '|') AS choices, chr(CAST(64 + list_position(choices, correct) AS INT)) AS answer,
           rationale, CASE WHEN t.r <= 150 THEN 'validation' ELSE split END AS split
    FROM s LEFT JOIN t USING (row_id)
""", "quiz")
def sciq_corpus(spark, sf):
    return Z.sciq_corpus(sciq_raw(spark, sf)).select("row_id", flat(), "answer", "rationale", "split")


APPENDED = f"""CASE WHEN contains(rationale, chr(10)) THEN {strip("left(rationale, length(rationale) - strpos(reverse(rationale), chr(10)))")}
                ELSE rationale END || chr(10) || 'The answer is: ' || answer"""
NO_STATEMENT = strip(
    "regexp_replace(regexp_replace(regexp_replace(rationale,"
    f" concat('(?i)[\\-=~>]*{SPACE}*the{SPACE}+correct{SPACE}+answer{SPACE}+is{SPACE}+', answer), '', 'g'),"
    f" concat('(?i)(answer|correct answer){SPACE}*:{SPACE}*', answer), '', 'g'),"
    f" concat('(?i)the answer is{SPACE}*:{SPACE}*', answer), '', 'g')"
)
NO_ANS = strip(f"regexp_replace(rationale, concat('Ans{SPACE}+', answer, '\\.?{SPACE}*(?:\\r?\\n)?'), '', 'g')")
PREFIXED = sub("rationale", f"(?i)^(solution|sol[.]?|explanation|expl){SPACE}*:?{SPACE}*[.]?{SPACE}*")


@query(f"""
    WITH raw AS (SELECT q.row_id, q.split, q.answer, q.choices, q.rationale, d.text AS question
                 FROM quiz q JOIN documents d ON d.doc_id = q.row_id
                 WHERE {strip('q.rationale')} <> '' AND {strip('d.text')} <> '' AND {canonical('d.text')} NOT IN
                       (SELECT {canonical('text')} FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))),
    a AS (SELECT row_id, split, question, answer, {STRIPPED} AS choices, {APPENDED} AS rationale FROM raw),
    b AS (SELECT * REPLACE ({NO_STATEMENT} AS rationale) FROM a
          WHERE row_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 45)),
    c AS (SELECT * REPLACE ({NO_ANS} AS rationale) FROM b),
    d AS (SELECT * REPLACE (translate({PREFIXED}, '–—', '--') AS rationale) FROM c
          WHERE NOT regexp_matches(rationale, 'https?://[^{SPACE_SET}]+') AND NOT regexp_matches(question, 'https?://[^{SPACE_SET}]+')),
    e AS (SELECT * FROM d WHERE NOT (regexp_matches(rationale, '{REFUSED}') OR regexp_matches(rationale, '{UNNAMED}'))
          AND (length(rationale) >= 27 OR (length({strip('rationale')}) >= 8 AND NOT contains(lower(rationale), 'option') AND NOT contains(lower(rationale), 'correct')))),
    f AS (SELECT row_id, split, rationale, choices[ord(answer) - 64] AS right_choice, {FOUR} AS choices FROM e),
    t AS (SELECT row_id, row_number() OVER (ORDER BY {key('42', 'row_id')}) AS r, count(*) OVER () AS n FROM f WHERE split = 'train')
    SELECT row_id, array_to_string(choices, '|') AS choices, chr(CAST(64 + list_position(choices, right_choice) AS INT)) AS answer,
           rationale, CASE WHEN r <= floor(n * 0.08::DOUBLE) THEN 'validation' ELSE split END AS split
    FROM f LEFT JOIN t USING (row_id)
""", "quiz")
def aqua_corpus(spark, sf):
    docs, labels = table(spark, sf, "documents", deal=True), table(spark, sf, "labels")
    texts = docs.select(F.col("doc_id").alias("row_id"), F.col("text").alias("question"))
    raw = view(spark, sf, "quiz").drop("question").join(texts, "row_id").select(
        "row_id", "split", "question", F.col("choices").alias("options"), "rationale", F.col("answer").alias("correct")
    )
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select(F.col("text").alias("Problem"))
    verdicts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("question_id"), F.when(F.col("p_size") > 45, "MISMATCH").otherwise("MATCH").alias("verdict")
    )
    return Z.aqua_corpus(raw, known, verdicts).select("row_id", flat(), "answer", "rationale", "split")


@query(f"""
    WITH raw AS (SELECT q.row_id, q.split, q.subject_name, q.question, q.rationale, CAST(m.cop AS INT) AS pos, q.choices AS old
                 FROM quiz q JOIN mcq5 m USING (row_id)
                 WHERE m.choice_type = 'single' AND regexp_full_match(m.cop, '[0-3]') AND q.split <> 'test'),
    a AS (SELECT row_id, split, subject_name, question, rationale, old[pos + 1] AS correct, {shuffled_sql('42', 'row_id', 'old')} AS choices FROM raw),
    b AS (SELECT *, chr(CAST(64 + list_position(choices, correct) AS INT)) AS answer,
                 row_number() OVER (PARTITION BY split, question, list_sort(choices) ORDER BY row_id) AS nth FROM a),
    c AS (SELECT * REPLACE ({MENTION} AS rationale) FROM b WHERE nth = 1 AND {strip('rationale')} <> '' AND NOT ({CITES})),
    cut AS (SELECT split, quantile_cont(length(rationale), 0.1) AS shortest FROM c WHERE rationale <> '' GROUP BY split),
    d AS (SELECT c.* FROM c JOIN cut USING (split) WHERE length(rationale) > shortest),
    t AS (SELECT row_id, row_number() OVER (ORDER BY {key('42', 'row_id')}) AS r FROM d WHERE split = 'train'),
    e AS (SELECT d.* REPLACE (CASE WHEN t.r <= 50 THEN 'validation' ELSE split END AS split) FROM d LEFT JOIN t USING (row_id)),
    f AS (SELECT row_id, subject_name, split, answer, rationale, array_to_string(choices, '|') AS choices FROM e
          WHERE {tokens(QUIZ_PROMPT)} + {tokens(QUIZ_COMPLETION)} + 1 <= 512),
    line AS (SELECT row_id, w, CAST(sum(w) OVER (ORDER BY {key('42', 'row_id')}) AS BIGINT) AS hi, CAST(sum(w) OVER () AS BIGINT) AS total
             FROM (SELECT row_id, CASE subject_name WHEN 'PROMO' THEN 10 WHEN 'SMALL' THEN 4 WHEN 'LARGE' THEN 7 WHEN 'ECONOMY' THEN 1 END AS w FROM f WHERE split = 'train')
             WHERE w IS NOT NULL),
    draws AS (SELECT ('0x' || substr({key('42-draw', 'row_id')}, 1, 15))::BIGINT % total AS u FROM line)
    SELECT f.* FROM draws d JOIN line l ON d.u >= l.hi - l.w AND d.u < l.hi JOIN f ON f.row_id = l.row_id
    UNION ALL SELECT * FROM f WHERE split <> 'train'
""", "mcq5 quiz")
def medmcqa_corpus(spark, sf):
    c = F.col("choices")
    raw = view(spark, sf, "quiz").join(
        view(spark, sf, "mcq5").select("row_id", "cop", "choice_type"), "row_id"
    ).select(
        "row_id", "split", "question", *[c[i].alias(n) for i, n in enumerate(("opa", "opb", "opc", "opd"))],
        "cop", "choice_type", F.col("rationale").alias("exp"), "subject_name",
    )
    weights = {"PROMO": 0.10, "SMALL": 0.04, "LARGE": 0.07, "ECONOMY": 0.01}
    rows = Z.medmcqa_corpus(raw, holdout_rows=50, weights=weights)
    return rows.select("row_id", "subject_name", "split", "answer", "rationale", flat())


def written(spark, sf, prefix):
    return view(spark, sf, "rationales").select(
        F.concat(prefix, F.col("row_id").cast("string")).alias("question_id"), "rationale"
    )


def written_sql(question_id, rationale, dataset):
    return f"""
    WITH s AS (SELECT row_id, split, choices[ord(answer) - 64] AS correct, {FOUR} AS choices FROM mcq5 WHERE split <> 'test')
    SELECT {question_id} AS question_id, array_to_string(choices, '|') AS choices, chr(CAST(64 + list_position(choices, correct) AS INT)) AS answer,
           {rationale} AS rationale, '{dataset}' AS dataset, s.split
    FROM s LEFT JOIN rationales r ON r.row_id = s.row_id
"""


PLAIN_TEXT = "coalesce(rationale, '')"


@query(written_sql(
    question_id="concat('ai2_arc_challenge_', s.row_id)", dataset="ai2_arc_challenge",
    rationale=sub(PLAIN_TEXT, f"(?i)^(exp(l(anation)?)?[.]?){SPACE}*:{SPACE}*"),
), "mcq5 rationales")
def arc_corpus(spark, sf):
    rows = Z.arc_corpus(labelled(spark, sf), written(spark, sf, F.lit("ai2_arc_challenge_")))
    return rows.select("question_id", flat(), "answer", "rationale", "dataset", "split")


@query(written_sql(
    question_id="concat(s.split, '_', s.row_id)", dataset="openbookqa", rationale=PLAIN_TEXT
), "mcq5 rationales")
def openbook_corpus(spark, sf):
    rows = Z.openbook_corpus(labelled(spark, sf), written(spark, sf, F.concat("split", F.lit("_"))))
    return rows.select("question_id", flat(), "answer", "rationale", "dataset", "split")


SOURCE_OF = "list_extract(['sciq', 'aqua_rat', 'medmcqa', 'ai2_arc_challenge', 'openbookqa'], CAST(row_id % 5 + 1 AS INT))"


def five_sources(spark, sf):
    """The quiz rows dealt out to the five sources."""
    names = F.array(*[F.lit(n) for n in ("sciq", "aqua_rat", "medmcqa", "ai2_arc_challenge", "openbookqa")])
    rows = view(spark, sf, "quiz").withColumn("dataset", F.element_at(names, (F.col("row_id") % 5 + 1).cast("int")))
    tables = []
    for name in ("sciq", "aqua_rat", "medmcqa", "ai2_arc_challenge", "openbookqa"):
        part = rows.where(F.col("dataset") == name)
        if name == "aqua_rat":
            part = part.drop("dataset")
        tables.append(part if name == "medmcqa" else part.drop("subject_name"))
    return tables


@query(f"""
    SELECT *, {key('42', 'dataset', 'row_id')} AS shuffle_key FROM (
    SELECT row_id, question, array_to_string(choices, '|') AS choices, answer, rationale, {SOURCE_OF} AS dataset, split
    FROM quiz) WHERE split IN ('train', 'validation')
""", "quiz")
def joint_corpus(spark, sf):
    joint = Z.joint_corpus(*five_sources(spark, sf))
    return joint.withColumn("choices", flat()).select("row_id", "question", "choices", "answer", "rationale", "dataset", "split", "shuffle_key")


@query(f"""
    SELECT {key('42', 'dataset', 'row_id')} AS shuffle_key, dataset, {QUIZ_PROMPT} AS prompt, {QUIZ_COMPLETION} AS completion
    FROM (SELECT *, {SOURCE_OF} AS dataset FROM quiz) WHERE split = 'validation'
""", "quiz")
def formatted_validation(spark, sf):
    return Z.formatted_validation(Z.joint_corpus(*five_sources(spark, sf)))


@query(f"""
    WITH j AS (SELECT *, {SOURCE_OF} AS dataset FROM quiz WHERE split = 'train'),
    s AS (SELECT *, CASE dataset WHEN 'sciq' THEN 0.2::DOUBLE WHEN 'aqua_rat' THEN 0.25::DOUBLE WHEN 'medmcqa' THEN 0.25::DOUBLE ELSE 0.15::DOUBLE END AS p,
                 count(*) OVER (PARTITION BY dataset) AS n, row_number() OVER (PARTITION BY dataset ORDER BY {key('42', 'row_id')}) AS r FROM j),
    q AS (SELECT *, CAST(floor((SELECT max(ceil(n / p)) FROM s) * p + 0.5) AS BIGINT) AS quota FROM s),
    c AS (SELECT *, unnest(range(1, quota // n + CASE WHEN r <= quota % n THEN 2 ELSE 1 END)) AS copy FROM q)
    SELECT {key('42-mix', 'dataset', 'row_id', 'copy')} AS mix_key, dataset, {QUIZ_PROMPT} AS prompt, {QUIZ_COMPLETION} AS completion FROM c
""", "quiz")
def mixed_training(spark, sf):
    return Z.mixed_training(staged(Z.joint_corpus(*five_sources(spark, sf)), "joint"))
