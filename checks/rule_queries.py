"""Row predicates and the tables they produce."""

from pyspark.sql import functions as F

from millrace.functions import rules as R
from millrace.functions.text import normalize_dashes, strip_solution_prefix
from millrace.operators.filtering import drop_shortest, flag_rows, partition_by_rule
from millrace.operators.profile import before_after_counts, violation_counts, violations
from millrace.operators.splits import drop_split, evaluation_split
from millrace.operators.workers import batch_predicate

from .base import END, SPACE, SPACE_SET, START, has, query, strip, sub, table, view


@query(f"""
    SELECT split, count(*) AS rows_before,
           CAST(count(*) FILTER ({strip("coalesce(rationale, '')")} <> '') AS BIGINT) AS rows_after
    FROM rationales GROUP BY split
""", "rationales")
def nonblank_partition_counts(spark, sf):
    return before_after_counts(view(spark, sf, "rationales"), R.has_text("rationale"))


@query(f"""
    SELECT lang, CAST(sum(kept) AS BIGINT) AS kept, CAST(sum(1 - kept) AS BIGINT) AS rejected
    FROM (SELECT lang, CASE WHEN {strip("coalesce(rationale, '')")} <> '' THEN 1 ELSE 0 END AS kept FROM rationales)
    GROUP BY lang
""", "rationales")
def keep_and_reject_tables(spark, sf):
    kept, rejected = partition_by_rule(view(spark, sf, "rationales"), R.has_text("rationale"))
    both = kept.select("lang", F.lit(1).alias("keep")).unionByName(
        rejected.select("lang", F.lit(0).alias("keep"))
    )
    return both.groupBy("lang").agg(
        F.count_if(F.col("keep") == 1).alias("kept"), F.count_if(F.col("keep") == 0).alias("rejected")
    )


@query(f"""
    WITH q AS (SELECT m.row_id, m.question, r.rationale, m.answer,
                      array_to_string(m.choices, ',') AS options FROM mcq5 m JOIN rationales r USING (row_id)),
    ok AS (SELECT row_id, question, rationale, answer,
                  list_filter(list_transform(string_split(options, ','), lambda o: {strip('o')}), lambda o: o <> '') AS opts FROM q)
    SELECT row_id, CAST(len(opts) AS INT) AS options FROM ok
    WHERE {strip('question')} <> '' AND {strip('rationale')} <> '' AND {strip('answer')} <> '' AND len(opts) >= 2
""", "mcq5 rationales")
def required_fields(spark, sf):
    joined = view(spark, sf, "mcq5").join(view(spark, sf, "rationales").select("row_id", "rationale"), "row_id")
    options = joined.withColumn("options", F.array_join("choices", ","))
    valid = options.where(R.has_required_fields("question", "rationale", "answer", "options", options_as_text=True))
    return valid.select("row_id", F.size(R.option_list("options")).alias("options"))


@query(f"""
    SELECT page_id FROM pages
    WHERE NOT ({has('url', f'https?://[^{SPACE_SET}]+')} OR {has('html', f'https?://[^{SPACE_SET}]+')})
    UNION ALL
    SELECT doc_id + 1000000000 AS page_id FROM documents
    WHERE NOT ({has('text', f'https?://[^{SPACE_SET}]+')} OR {has('lang', f'https?://[^{SPACE_SET}]+')} OR {has('source', f'https?://[^{SPACE_SET}]+')})
""")
def url_filter_any_column(spark, sf):
    pages, docs = table(spark, sf, "pages"), table(spark, sf, "documents", deal=True)
    return pages.where(~R.url_in_any_string(pages)).select("page_id").unionByName(
        docs.where(~R.url_in_any_string(docs)).select((F.col("doc_id") + 1000000000).alias("page_id"))
    )


LOOSE = has("rationale", f"(?i)(https?{SPACE}*:{SPACE}*//|www{SPACE}*[.])")
FIGURE = has("rationale", f"(?i){START}(see|as{SPACE}+shown{SPACE}+in|refer{SPACE}+to){SPACE}+Figure{END}")


@query(f"SELECT row_id, rationale FROM rationales WHERE NOT ({LOOSE} OR {FIGURE})", "rationales")
def url_loose_figure_filter(spark, sf):
    rule = R.has_loose_url("rationale") | R.has_figure_reference("rationale")
    return view(spark, sf, "rationales").where(~rule).select("row_id", "rationale")


@query(f"SELECT split, row_id FROM rationales WHERE {LOOSE}", "rationales")
def violation_list(spark, sf):
    return violations(view(spark, sf, "rationales"), R.has_loose_url("rationale"), "row_id")


@query(f"SELECT split, count(*) AS violations FROM rationales WHERE {LOOSE} OR {FIGURE} GROUP BY split", "rationales")
def violation_totals(spark, sf):
    rule = R.has_loose_url("rationale") | R.has_figure_reference("rationale")
    return violation_counts(view(spark, sf, "rationales"), rule)


BOOKS = "harrison|guyton|robbins|chandrasoma|kdt|bdc|snell|goodman|gilman|harper|uptodate|lippincott|ganong|grays|netter"
CITES = " OR ".join(
    has("lower(rationale)", p) for p in (
        f"{START}ref(er)?{END}", rf"{START}chapter{SPACE}*\p{{Nd}}+", rf"{START}p(ages?|g)?[.]?{SPACE}*\p{{Nd}}+",
        rf"{START}volume{SPACE}*\p{{Nd}}+", f"{START}[1-9][0-9]?(/?e|th edition){END}", "https?://",
        f"{START}www[.]", f"{START}({BOOKS}){END}",
    )
)


@query(f"SELECT row_id, split FROM rationales WHERE NOT ({CITES})", "rationales")
def citation_filter(spark, sf):
    return view(spark, sf, "rationales").where(~R.cites_reference("rationale")).select("row_id", "split")


@query("""
    SELECT row_id, cop FROM mcq5
    WHERE choice_type = 'single' AND regexp_full_match(trim(cop), '[0-9]+') AND CAST(trim(cop) AS INT) BETWEEN 0 AND 3
""", "mcq5")
def numeric_answer_filter(spark, sf):
    return view(spark, sf, "mcq5").where(R.is_single_choice("choice_type", "cop")).select("row_id", "cop")


@query("""
    SELECT row_id FROM mcq5
    WHERE answer IN ('A', 'B', 'C', 'D') AND question <> '' AND len(choices) = 5
      AND len(list_filter(choices[2:5], lambda c: c = '')) = 0
""", "mcq5")
def mcq_integrity(spark, sf):
    rows = view(spark, sf, "mcq5").withColumn("choices", F.slice("choices", 2, 4))
    return rows.where(R.is_complete_mcq("question", "choices", "answer")).select("row_id")


REFUSED = (
    r"[^\x{0}-\x{7f}⁄×⇒→…‘’“”−∴∵πθαβΔ\x{f0de}‹›€\p{Sm}\p{Ll}\p{Greek}\x{342}-\x{345}\x{374}\x{37e}\x{385}\x{387}"
    r"\x{2129}\x{2719}\x{271a}\x{1f7a1}-\x{1f7a7}\x{1fbbb}]"
)
UNNAMED = r"[\x{1d5d}\x{1d5f}\x{1d61}\x{1dbf}\x{2126}\x{1018e}]"


@query(f"""
    SELECT doc_id, lang, {has('text', REFUSED)} OR {has('text', UNNAMED)} AS was_filtered FROM documents
""")
def charset_allow_list(spark, sf):
    docs = table(spark, sf, "documents", deal=True)
    return flag_rows(docs, R.has_only_allowed_characters("text")).select("doc_id", "lang", "was_filtered")


CLEAN = f"translate({sub('rationale', f'(?i)^(solution|sol[.]?|explanation|expl){SPACE}*:?{SPACE}*[.]?{SPACE}*')}, '–—', '--')"


@query(f"""
    WITH c AS (SELECT row_id, {CLEAN} AS rationale FROM rationales)
    SELECT row_id, rationale FROM c
    WHERE length(rationale) >= 27
       OR (length({strip('rationale')}) >= 8 AND NOT contains(lower(rationale), 'option') AND NOT contains(lower(rationale), 'correct'))
""", "rationales")
def short_rationale_rescue(spark, sf):
    rows = view(spark, sf, "rationales").withColumn(
        "rationale", normalize_dashes(strip_solution_prefix("rationale"))
    )
    return rows.where(R.is_long_or_valid_short("rationale")).select("row_id", "rationale")


@query("""
    WITH cuts AS (SELECT lang, quantile_cont(length(text), 0.1) AS cut FROM documents WHERE text <> '' GROUP BY lang)
    SELECT doc_id, lang FROM documents JOIN cuts USING (lang) WHERE length(text) > cut
""")
def percentile_length_filter(spark, sf):
    return drop_shortest(table(spark, sf, "documents", deal=True), "text", 0.1, ["lang"]).select("doc_id", "lang")


@query("SELECT row_id, split FROM mcq5 WHERE split <> 'test'", "mcq5")
def split_exclude(spark, sf):
    return drop_split(view(spark, sf, "mcq5")).select("row_id", "split")


@query("""
    WITH m AS (SELECT row_id, subject_name AS dataset,
                      CASE WHEN split = 'validation' AND subject_name IN ('PROMO', 'SMALL') THEN 'train' ELSE split END AS split
               FROM mcq5),
    f AS (SELECT dataset, max(CASE WHEN split = 'validation' THEN 1 ELSE 0 END) AS has FROM m GROUP BY dataset)
    SELECT row_id, dataset, split FROM m JOIN f USING (dataset)
    WHERE split = CASE WHEN has = 1 THEN 'validation' ELSE 'test' END
""", "mcq5")
def split_fallback(spark, sf):
    rows = view(spark, sf, "mcq5").withColumnRenamed("subject_name", "dataset").withColumn(
        "split",
        F.when((F.col("split") == "validation") & F.col("dataset").isin("PROMO", "SMALL"), "train").otherwise(F.col("split")),
    )
    return evaluation_split(rows).select("row_id", "dataset", "split")


@query("SELECT doc_id, quality FROM labels WHERE toxic = 1")
def bool_flag_filter(spark, sf):
    flagged = table(spark, sf, "labels").withColumn("was_cleaned", F.col("toxic") == 1)
    return flagged.where(F.col("was_cleaned")).select("doc_id", "quality")


@query("SELECT row_id, subject_name FROM mcq5 WHERE subject_name = 'PROMO'", "mcq5")
def dataset_eq(spark, sf):
    return view(spark, sf, "mcq5").where(F.col("subject_name") == "PROMO").select("row_id", "subject_name")


@query("SELECT doc_id FROM documents WHERE length(text) > 500 AND strpos(lower(text), 'the') > 0")
def pandas_predicate_filter(spark, sf):
    long_english = batch_predicate(lambda texts: [len(t) > 500 and "the" in t.lower() for t in texts])
    return table(spark, sf, "documents", deal=True).where(long_english("text")).select("doc_id")
