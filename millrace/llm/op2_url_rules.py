"""URL filter: hash-prefix lookup of host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import query, table

HEX_PREFIX = 8  # four bytes of the digest


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and all its parent domains, cut at the dots."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def _digests(rules: DataFrame) -> DataFrame:
    rules = rules.select(
        F.coalesce("host", F.lit("")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict"
    )
    # one verdict per expression: block wins over allow
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    return rules.withColumn("digest", F.sha2(F.concat_ws("\n", "rule_host", "rule_path").cast("binary"), 256))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules`` has the columns host, path and verdict (allow or block).  Every
    distinct url is expanded into (host suffix, path prefix) expressions; path
    prefixes have the lengths that rules have, so a rule may end anywhere in a
    path.  Expressions meet rules by the first four bytes of their digest; the
    whole digest confirms.  The longest rule wins, then the longer host; of
    equal rules block wins.  Both joins are plain equi-joins: Spark broadcasts
    the rules if they are small and splits frequent keys if they are not.

    A null url, or one without ``://``, has empty host and path and meets no
    rule.  Repeated rows are kept; the url is judged once.  Columns that the
    result adds must not exist before (``ValueError``).
    """
    clash = {"host", "path", "rule", "verdict"} & set(pages.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    known = _digests(rules).withColumn("hash_prefix", F.substring("digest", 1, HEX_PREFIX))
    lengths = rules.select(F.length(F.coalesce("path", F.lit(""))).alias("n")).agg(F.collect_set("n")).scalar()
    urls = pages.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    expressions = (
        urls.withColumn("lengths", lengths)
        .select("url", "path", F.explode(host_suffixes(F.col("host"))).alias("suffix"), "lengths")
        .select("url", "suffix", "path", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("cut"))
        .select("url", "suffix", F.expr("left(path, cut)").alias("prefix"))
        .withColumn("full", F.sha2(F.concat_ws("\n", "suffix", "prefix").cast("binary"), 256))
        .withColumn("hash_prefix", F.substring("full", 1, HEX_PREFIX))
    )
    hits = expressions.join(known, "hash_prefix").where(F.col("full") == F.col("digest"))
    best = hits.groupBy("url").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"),
        F.concat("rule_host", "rule_path").alias("rule"), "verdict")).alias("best"))
    judged = best.select(F.col("url").alias("__url"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    return (
        pages.join(judged, F.col(url) == F.col("__url"), "left").drop("__url")
        .withColumn("host", host_of(F.col(url)))
        .withColumn("path", path_of(F.col(url)))
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    )


#: The rules of the registered query.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)

OP2_SQL = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
numbered AS (SELECT *, row_number() OVER () AS n FROM split),
hits AS (
    SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM numbered JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY n)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM numbered LEFT JOIN hits USING (n)
"""


@query(OP2_SQL)
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every url of ``pages``."""
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")
