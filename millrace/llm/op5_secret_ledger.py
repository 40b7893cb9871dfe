"""Secret scan: an incremental ledger of content-addressed versions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from millrace.session import work_path

from .base import query, table, with_arrays

#: Kind, version of the rule, pattern, group that is measured, least length.
#: All patterns are ASCII; runs are maximal, so a least length in the pattern is the same
#: as dropping short runs, except for ``assign``, where a short match uses up its text.
RULES = (
    ("assign", 1, r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    ("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)
LEDGER_SETTING = "spark.millrace.secretLedger"  # a folder that all executors reach
SENT_BYTES = 1 << 25  # findings that are broadcast to be joined back to texts
LEDGER = T.StructType([
    T.StructField("blob", T.BinaryType()), T.StructField("kind", T.StringType()), T.StructField("version", T.IntegerType()),
    T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())),
])


def spans_of(text: str, pattern: re.Pattern, group: int, least: int) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches in code points, without those whose group is too short."""
    return [m.span() for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def _scanner(rules):
    compiled = {kind: (version, re.compile(pattern, re.ASCII), group, least) for kind, version, pattern, group, least in rules}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for blob, text, kinds in zip(batch["blob"], batch["text"], batch["kinds"], strict=True):
                for kind in kinds:
                    version, pattern, group, least = compiled[kind]
                    spans = spans_of(text, pattern, group, least)
                    rows.append((blob, kind, version, [s for s, _ in spans], [e for _, e in spans]))
            yield pd.DataFrame(rows, columns=LEDGER.names)

    return scan


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def blob_of(text: str = "text"):
    """The address of a version: SHA-256 of its UTF-8 bytes (null: of no bytes)."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def update_ledger(versions: DataFrame, ledger_path: str, rules=RULES) -> DataFrame:
    """Scan what the ledger has not seen, add it, and return the ledger's rows for these rules.

    ``versions`` has the columns path and text: any number of versions of any
    number of paths.  Each distinct text is one blob.  A (blob, kind, version)
    that the ledger holds is not scanned again; a rule with a new version is,
    for all blobs.  Of equal texts one copy is chosen by (blob, path) before any
    text is moved, so a text with very many copies is neither scanned nor
    gathered more than once (twice only if path and text repeat).
    A null text is the empty blob, an empty table adds nothing, null paths count
    as one path.  A lost write is repeated as a whole; a blob that two runs
    added counts once.
    """
    spark = versions.sparkSession
    current = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{k}', {v})" for k, v, *_ in rules) + " AS t(kind, version)")
    kinds = F.array(*[F.lit(kind) for kind, *_ in rules])
    seen = (
        _ledger(spark, ledger_path).join(F.broadcast(current), ["kind", "version"])  # one row per rule
        .groupBy("blob").agg(F.collect_set("kind").alias("seen"))
    )
    address = F.struct(F.col("path").isNull().alias("no_path"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"))
    texts = versions.select(
        blob_of().alias("blob"), address.alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    unseen = (
        texts.groupBy("blob").agg(F.min("at").alias("at")).join(seen, "blob", "left")
        .select("blob", "at", F.when(F.col("seen").isNull(), kinds).otherwise(F.array_except(kinds, "seen")).alias("kinds"))
        .where(F.size("kinds") > 0)
    )
    found = texts.join(unseen, ["blob", "at"]).select("blob", "text", "kinds").mapInPandas(_scanner(rules), LEDGER)
    found.write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER).parquet(ledger_path).join(F.broadcast(current), ["kind", "version"]).dropDuplicates(["blob", "kind"])


def findings(versions: DataFrame, ledger_path: str, rules=RULES) -> DataFrame:
    """One row per blob that holds a secret: ``spans`` (start, end, kind), in order of start, then of the rules."""
    rank = F.create_map(*[F.lit(x) for n, (kind, *_) in enumerate(rules) for x in (kind, n)])
    per_kind = update_ledger(versions, ledger_path, rules).select("blob", F.transform(
        F.arrays_zip("starts", "ends"),
        lambda s: F.struct(s["starts"].alias("start"), rank[F.col("kind")].alias("rank"), s["ends"].alias("end"), F.col("kind").alias("kind")),
    ).alias("spans"))
    return (
        per_kind.where(F.size("spans") > 0).groupBy("blob")
        .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))  # at most one list per rule
    )


def scan(docs: DataFrame, ledger_path: str, rules=RULES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Join the findings back to every row of ``docs``: its columns and ``spans`` (empty where nothing was found).

    A column ``spans`` of ``docs``, in whatever case, gives way to that of the result.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "spans"])
    blob = "__blob"
    while blob in docs.columns:
        blob += "_"
    found = findings(docs.select(F.col(id_column).alias("path"), F.col(text).alias("text")), ledger_path, rules)
    found = found.withColumnRenamed("blob", blob)
    empty = F.array().cast(found.schema["spans"].dataType)
    seen = found.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("spans")), F.lit(0)).alias("spans")).first()
    if 64 * seen["n"] + 48 * seen["spans"] <= SENT_BYTES:  # else texts and findings meet by a shuffle
        found = F.broadcast(found)
    return (
        docs.withColumn(blob, blob_of(text))
        .join(found, blob, "left")
        .withColumn("spans", F.coalesce("spans", empty)).drop(blob)
    )


def redacted(rows: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """Replace what ``spans`` covers in ``text`` by ``mark``; overlapping spans become one mark."""

    def make():
        def run(batch):
            texts = []
            for value, spans in zip(batch.column(text).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                pieces, at = [], 0
                for span in spans:
                    if span["start"] >= at:
                        pieces += [value[at : span["start"]], mark]
                    at = max(at, span["end"])
                texts.append("".join([*pieces, value[at:]]) if pieces else value)
            return (texts,)

        return run

    # only rows with secrets go through Python
    changed = with_arrays(rows.where(F.size("spans") > 0), {}, make, replaced=(text,), dropped=("spans",))
    return changed.unionByName(rows.where(F.size("spans") == 0).drop("spans"))


def _written(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda value: value == kind


def ledger_of(spark: SparkSession) -> str:
    """The ledger that lasts from run to run, as the session's ``LEDGER_SETTING`` names it; a new one where that is not set."""
    return spark.conf.get(LEDGER_SETTING, None) or work_path(spark, "secret-ledger")


@query()
def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document; blobs that the session's ledger knows are not scanned again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = findings(docs.withColumnRenamed("doc_id", "path"), ledger_of(spark))
    per_blob = found.select(
        "blob", *[F.array_size(F.filter(F.col("spans.kind"), _is(kind))).cast("long").alias(f"n_{kind}") for kind, *_ in RULES],
        _written("spans").alias("spans"))
    rows = docs.select("doc_id", blob_of().alias("blob")).join(per_blob, "blob", "left")
    spans = F.coalesce("spans", F.lit(""))
    return rows.select(
        "doc_id", *[F.coalesce(f"n_{kind}", F.lit(0).cast("long")).alias(f"n_{kind}") for kind, *_ in RULES],
        F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def brute_force(text: str | None) -> tuple[int, int, int, str, str]:
    """The expected row of one text, from the literal patterns; for tests."""
    literal = (
        ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE, 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 0, 18), ("hex", r"[0-9a-f]+", 0, 0, 16),
    )
    spans = sorted(
        (m.start(), n, m.end(), kind)
        for n, (kind, pattern, flags, group, least) in enumerate(literal)
        for m in re.finditer(pattern, text or "", re.ASCII | flags) if len(m[group]) >= least
    )
    written = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
    counts = [sum(s[1] == n for s in spans) for n in range(3)]
    return (*counts, hashlib.sha256(written.encode()).hexdigest(), written)
