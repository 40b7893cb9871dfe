"""The corpus pipeline: language, near duplicates, benchmark passages, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet in the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import op4_pfair_mix, op5_secret_ledger, op6_token_groups, op8_language, op9_spaced_seeds
from millrace.session import work_path

LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay.

    Those without a letter go, and those that no language explains better than
    all others together.
    """
    known = op8_language.learn_and_identify(docs)
    return known.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the document with the least id stays, of null or equal ids one row."""
    return op6_token_groups.keep_first(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with substituted words, go; rows without a text stay, as do all without a benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return op9_spaced_seeds.without_overlaps(docs, benchmark)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark, and n_chars follows.

    Texts that the session's ledger knows from an earlier run are not scanned again.  A null text stays null.
    """
    found = op5_secret_ledger.scan(docs, op5_secret_ledger.ledger_of(spark))
    clean = op5_secret_ledger.redacted(found)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, with their redacted texts, in training order; no rows give none."""
    return op4_pfair_mix.mix(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_passages),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]
ORACLE_SQL = None  # trained and iterative stages; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return kept
        path = work_path(spark, f"pipeline-{number}-{name}")
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
