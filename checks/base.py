"""Query registry, test views, and the SQL vocabulary of the expected results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.columns import computed_once
LONG_TEXTS = ("rationales", "quiz")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, views: str = ""):
    """Register a query under its function name.

    ``views`` names the test views its SQL uses.  Without SQL only the rows of
    the query are looked at.
    """

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = with_views(sql, views)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str, deal: bool = False) -> DataFrame:
    """A given table; how its rows are dealt to tasks is left to the scan (``deal`` marks long texts)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Views, in SQL both engines read; <list>..</list> stands for an array literal.
VIEWS = {
    "mcq5": """
        SELECT p_partkey AS row_id, concat('part_', CAST(p_partkey AS STRING)) AS question_id,
               concat('Which item is number ', CAST(p_partkey AS STRING), '?') AS question,
               <list>concat(CASE WHEN p_partkey % 3 = 0 THEN '(A)* ' ELSE '' END, p_name),
                     concat(CASE WHEN p_partkey % 3 = 0 THEN '(B) ' ELSE '' END, p_brand),
                     concat(CASE WHEN p_partkey % 3 = 0 THEN 'C) ' ELSE '' END, p_type),
                     concat('size ', CAST(p_size AS STRING)),
                     CASE WHEN p_partkey % 17 = 0 THEN ''
                          ELSE concat('price ', CAST(CAST(round(p_retailprice) AS BIGINT) AS STRING)) END</list> AS choices,
               substr('ABCDE', CAST(p_partkey % 5 AS INT) + 1, 1) AS answer,
               CASE WHEN p_partkey % 11 = 0 THEN 'x' WHEN p_partkey % 13 = 0 THEN '7'
                    ELSE CAST(p_partkey % 4 AS STRING) END AS cop,
               CASE WHEN p_partkey % 7 = 0 THEN 'multi' ELSE 'single' END AS choice_type,
               p_type AS subject_name,
               CASE WHEN p_partkey % 10 = 0 THEN 'test' WHEN p_partkey % 10 = 1 THEN 'validation'
                    ELSE 'train' END AS split
        FROM {part}""",
    "mcq4": """
        SELECT row_id, question_id, question, <first4>choices</first4> AS choices,
               substr('ABCD', CAST(row_id % 4 AS INT) + 1, 1) AS answer, subject_name, split
        FROM {mcq5}""",
    "rationales": """
        SELECT row_id, source, lang, answer, split,
               CASE CAST(row_id % 12 AS INT)
                    WHEN 0 THEN concat('  ', t, ' ')
                    WHEN 1 THEN concat('Explanation: ', t)
                    WHEN 2 THEN concat('Sol. ', t)
                    WHEN 3 THEN concat(t, chr(10), 'The answer is: ', answer)
                    WHEN 4 THEN concat('Ans. (', answer, ') ', t)
                    WHEN 5 THEN concat(t, ' Ref: Harrison 17th edition p. 123')
                    WHEN 6 THEN concat(t, ' as shown in Figure 3')
                    WHEN 7 THEN concat(t, ' http : //x.example')
                    WHEN 8 THEN concat('Ans ', answer, '. ', t)
                    WHEN 9 THEN concat(t, ' option ', answer)
                    WHEN 10 THEN concat(lang, ' only ', source, ' ', t)
                    ELSE t END AS rationale
        FROM (SELECT doc_id AS row_id, source, lang, text AS t,
                     substr('ABCD', CAST(doc_id % 4 AS INT) + 1, 1) AS answer,
                     CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'validation'
                          ELSE 'train' END AS split
              FROM {documents}) d""",
    "pairs": """
        SELECT u.conv_id * 100 + u.turn AS row_id,
               CASE WHEN u.conv_id % 2 = 0 THEN 'metamath' ELSE 'codealpaca' END AS dataset,
               CASE WHEN u.conv_id % 2 = 0
                    THEN concat('Question: 1+1?', chr(10), 'Answer: 2', chr(10), chr(10), 'Question: ',
                                replace(u.text, chr(10), ' '), chr(10), 'Answer:')
                    ELSE u.text END AS prompt,
               a.text AS chosen, r.text AS rejected
        FROM {conversations} u
        LEFT JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        LEFT JOIN {conversations} r ON r.conv_id = u.conv_id + 1 AND r.turn = u.turn + 1 AND r.role = 'assistant'
        WHERE u.role = 'user'""",
    "quiz": """
        SELECT m.row_id, m.question_id, m.question, m.choices, m.answer, m.subject_name, m.split,
               coalesce(r.rationale, '') AS rationale
        FROM (SELECT q.*, q.row_id % n.n AS document FROM {mcq4} q JOIN (SELECT count(*) AS n FROM {rationales}) n ON true) m
        LEFT JOIN {rationales} r ON r.row_id = m.document""",
}
USES = {"mcq5": ["part"], "mcq4": ["mcq5"], "rationales": ["documents"], "pairs": ["conversations"],
        "quiz": ["mcq4", "rationales"]}
SPARK_DIALECT = {"<list>": "array(", "</list>": ")", "<first4>": "slice(", "</first4>": ", 1, 4)"}
DUCK_DIALECT = {"<list>": "[", "</list>": "]", "<first4>": "", "</first4>": "[1:4]"}


def _spelled(text: str, dialect: dict[str, str]) -> str:
    for mark, spelling in dialect.items():
        text = text.replace(mark, spelling)
    return text


def view(spark: SparkSession, folder: str, name: str, deal: bool = False) -> DataFrame:
    """A test view as a DataFrame over the given tables."""
    if name not in VIEWS:
        return table(spark, folder, name, deal)
    deal = deal or name in LONG_TEXTS
    inputs = {used: view(spark, folder, used, deal) for used in USES[name]}
    df = spark.sql(_spelled(VIEWS[name], SPARK_DIALECT), **inputs)
    # filters of a query then run on the dealt-out rows, not inside the one-file scan
    return computed_once(df, rationale=df["rationale"]) if name == "rationales" else df


def with_views(sql: str, views: str) -> str:
    """Put the definitions of the named views in front of a statement."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in needed:
            for used in USES[name]:
                add(used)
            needed.append(name)

    for name in views.split():
        add(name)
    if not needed:
        return sql
    definitions = []
    for name in needed:
        text = _spelled(VIEWS[name], DUCK_DIALECT)
        for used in USES[name]:
            text = text.replace("{" + used + "}", used)
        definitions.append(f"{name} AS ({text})")
    head = "WITH " + ", ".join(definitions)
    body = sql.strip()
    return f"{head}, {body[5:]}" if body[:5].upper() == "WITH " else f"{head} {body}"


# -- vocabulary of the expected results (RE2 dialect) ---------------------------
SPACE_SET = r"\t\n\x{0b}\f\r\x{1c}\x{1d}\x{1e}\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{SPACE_SET}]"
WORD_SET = r"\p{L}\p{N}_"
WORD = f"[{WORD_SET}]"
TOKENS = rf"{WORD}+|[^{WORD_SET}{SPACE_SET}]"
START = rf"(?:^|[^{WORD_SET}])"  # a word begins here
END = rf"(?:$|[^{WORD_SET}])"
SPACES = "".join(map(chr, (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203),
                           8232, 8233, 8239, 8287, 12288)))


def strip(value: str) -> str:
    return f"trim({value}, '{SPACES}')"


def sub(value: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({value}, '{pattern}', {to}, 'g')"


def has(value: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({value}, '{pattern}'), false)"


def key(seed: str, *parts: str) -> str:
    joined = ", ':', ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5(concat('{seed}:', {joined}))"


def tokens(value: str) -> str:
    return f"len(regexp_extract_all({value}, '{TOKENS}'))"


def canonical(value: str) -> str:
    numbered = sub(f"lower({value})", r"\p{Nd}+([.,]\p{Nd}+)?", "'<num>'")
    return f"trim({sub(numbered, SPACE + '+', chr(39) + ' ' + chr(39))}, ' ?.')"


def spaced(value: str) -> str:
    return sub(strip(value), SPACE + "+", "' '")


def shuffled_sql(seed: str, row_id: str, choices: str) -> str:
    """The choices in order of the per-choice hash (positions from 0)."""
    keyed = (
        f"list_transform({choices}, lambda c, i: {{'k': {key(seed, row_id, 'i - 1')}, 'c': c}})"
    )
    return f"list_transform(list_sort({keyed}), lambda s: s.c)"
