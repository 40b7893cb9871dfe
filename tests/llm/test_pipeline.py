import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from compare import TABLES, rows_of
from millrace import llm
from millrace.llm.op5_secret_ledger import brute_force

from .test_token_groups import brute as components

FOLDER = "/root/testdata/sf0.001"


def staged(spark, docs, folder=FOLDER):
    """The rows after every stage."""
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        yield rows
        docs = spark.createDataFrame(rows, docs.schema)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(120)
    start = docs.collect()
    language, groups, clean, secrets, mixed = staged(spark, spark.createDataFrame(start, docs.schema))
    assert {r["doc_id"] for r in language} == {r["doc_id"] for r in start if any(c.isalpha() for c in r["text"])}
    kept = {doc_id for doc_id, _, root in components([(r["doc_id"], r["text"]) for r in language]) if doc_id == root}
    assert {r["doc_id"] for r in groups} == kept
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holds = {r["doc_id"] for r in groups if any(i in " ".join(r["text"].split()) for i in items)}
    gone = kept - {r["doc_id"] for r in clean}
    assert holds <= gone
    assert {r["doc_id"] for r in secrets} == {r["doc_id"] for r in clean}
    before = {r["doc_id"]: r["text"] for r in clean}
    for r in secrets:
        assert brute_force(r["text"])[:3] == (0, 0, 0)
        assert (r["text"] == before[r["doc_id"]]) == (brute_force(before[r["doc_id"]])[4] == "")
    assert sorted(r["position"] for r in mixed) == list(range(len(secrets)))
    assert {r["doc_id"] for r in mixed} == {r["doc_id"] for r in secrets}


def test_stages_return_the_columns_of_documents_and_survive_edges(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    some = docs.limit(20).collect()
    odd = [(None, None, None, None, None), (10**6, "", "x", None, 0), (10**6 + 1, "12 34", "x", "s", 5), tuple(some[0]), (10**6 + 2, "wort " * 30_000, "de", "s", None)]
    for rows in ([], some + odd):
        *stages, _ = staged(spark, spark.createDataFrame([tuple(r) for r in rows], docs.schema))
        assert all(set(rows[0].__fields__) == set(docs.columns) for rows in stages if rows)


def test_queries_with_sql(spark):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    for name, sql in llm.SQL.items():
        df = llm.QUERIES[name](spark, FOLDER)
        result = connection.execute(sql)
        columns = [d[0] for d in result.description]
        assert sorted(df.columns) == sorted(columns)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in llm.QUERIES} and "pipeline" in names


def test_mixing_returns_the_texts_of_the_stage_before(spark):
    rows = [(n if n < 40 else None, f"text {n % 45}", "de", "s" if n % 3 else None, 6) for n in range(50)]
    docs = spark.createDataFrame([*rows, (1, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    key = lambda r: repr(tuple(r[c] for c in docs.columns))
    found = mixed.collect()
    assert sorted(map(key, found)) == sorted(map(key, docs.collect()))
    assert sorted(r["position"] for r in found) == list(range(51))
