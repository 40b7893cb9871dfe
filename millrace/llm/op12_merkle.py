"""A Merkle manifest of a dataset: leaves per row, a subroot per source, one root, and a proof per row.

Nodes of a level are kept as one hex string per aligned block of 256 leaves.
Parents are hashes of substrings of fixed width, siblings in a proof are the
substrings on both sides of a node, and the tops of blocks are the leaves of
the next round, until one node of each tree is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import staged

from .base import query, table

RUN = 16  # nodes under one parent
BLOCK = RUN * RUN  # leaves of a block: two levels, a string of 16 KB
HEX = 64  # characters of a node
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before: string, after: string>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """UTF-8 byte count, a colon and the value; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(F.concat(*map(field, values)))


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, start, lambda own, level: digest(F.concat(level["before"], own, level["after"])))


def siblings(path: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``position`` (from 0) and ``n`` within each ``tree``, in ascending order of the columns.

    Rows are sorted in ranges of (tree, order), so a tree that holds most rows has
    many ranges; a random last key splits rows that are equal in all others.  The
    sorted rows are stored before their ranges are counted, so a task that runs
    again cannot move a border.
    """
    keys = ["tree", *order, "__tie"]
    rows = nodes.withColumn("__tie", F.rand(1)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = staged(rows.withColumn("__at", F.monotonically_increasing_id()).drop("__tie"), "merkle-order")
    rows = rows.withColumn("__range", F.shiftright("__at", 33))
    ranges = rows.groupBy("tree", "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        F.col("tree").alias("__tree"), F.col("__range").alias("__r"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(whole).alias("n"))
    found = rows.join(ranges, (F.col("tree") == F.col("__tree")) & (F.col("__range") == F.col("__r")))
    return found.withColumn("position", F.col("__at") + F.col("__shift")).drop("__at", "__range", "__tree", "__r", "__shift")


def _parents(level: Column) -> Column:
    """The level above: one hash of every ``RUN`` nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / (RUN * HEX)).cast("int"))
    return F.array_join(F.transform(runs, lambda i: digest(F.substring(level, i * (RUN * HEX) + 1, F.lit(RUN * HEX)))), "")


def _beside(level: Column, index: Column) -> Column:
    """The nodes of the same run on both sides of the node at ``index``."""
    own = index % RUN
    return F.struct(
        F.substring(level, (index - own) * HEX + 1, own * HEX).alias("before"),
        F.substring(level, (index + 1) * HEX + 1, (RUN - 1 - own) * HEX).alias("after"))


def _climb(nodes: DataFrame, most: int) -> DataFrame:
    """Blocks of nodes with ``above`` (the path from the block's top) and ``root`` of their tree.

    ``most`` is the size of the largest tree.  Nodes are (tree, position, n, node,
    item).  A block is one row of at most ``BLOCK`` nodes whatever the size of a tree.
    """
    blocks = (
        nodes.withColumn("block", F.expr(f"position div {BLOCK}")).groupBy("tree", "block", "n")
        .agg(F.sort_array(F.collect_list(F.struct("position", "node", "item"))).alias("members"))
        .withColumn("level0", F.array_join("members.node", ""))
        .withColumn("level1", F.when(F.col("n") > 1, _parents(F.col("level0"))))
        .withColumn("level2", F.when(F.col("n") > RUN, _parents(F.col("level1"))))
        .withColumn("top", F.coalesce("level2", "level1", "level0")).drop("level2")
    )
    blocks = staged(blocks, "merkle-blocks")
    done = blocks.where(F.col("n") <= BLOCK).select(
        F.col("tree").alias("__tree"), F.col("block").alias("__block"), F.array().cast(PATH).alias("above"), F.col("top").alias("root"))
    if most > BLOCK:
        tops = blocks.where(F.col("n") > BLOCK).select(
            "tree", F.col("block").alias("position"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("node"), F.lit(None).cast("int").alias("item"))
        higher = _paths(_climb(tops, -(-most // BLOCK)))
        done = done.union(higher.select("tree", "position", "path", "root"))
    return blocks.join(done, (F.col("tree") == F.col("__tree")) & (F.col("block") == F.col("__block"))).drop("__tree", "__block")


def _paths(blocks: DataFrame) -> DataFrame:
    """One row per node of the blocks, with its path and the root."""
    at = (F.col("member.position") % BLOCK).cast("int")
    own = F.when(F.col("n") > RUN, F.array(_beside(F.col("level0"), at), _beside(F.col("level1"), F.floor(at / RUN).cast("int"))))
    own = own.when(F.col("n") > 1, F.array(_beside(F.col("level0"), at))).otherwise(F.array().cast(PATH))
    rows = blocks.withColumn("member", F.explode("members"))
    return rows.select(
        "tree", F.col("member.position").alias("position"), F.col("member.node").alias("node"), F.col("member.item").alias("item"),
        F.concat(own, F.col("above")).alias("path"), *[c for c in ("subroot", "root") if c in blocks.columns])


def prove(docs: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, ``leaf``, ``subroot``, ``root`` and ``path`` of every row of (doc_id, source, lang, n_chars, text).

    ``path`` has the siblings before and after the node on each level, from the
    leaf to the root.  ``carried`` adds narrow columns computed from the rows.  Texts
    are only read where they are; what moves is a hash per row.

    Any column may be null, also the id (null ids come first); rows with equal
    ids are ordered by their leaves, equal rows stay as equal leaves next to
    each other.  Null is a source of its own, ahead of the others.  Other
    columns of ``docs`` are ignored.  An empty table gives no rows.
    """
    carried = carried or {}
    item = F.struct(F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(name) for name, c in carried.items()])
    # a name for each source that orders as the sources do, null first
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-"))
    made = leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    # stored, as sorting in ranges reads its rows twice
    leaves = staged(docs.select(tree.alias("tree"), made.alias("node"), item.alias("item")).withColumn("id", F.col("item.doc_id")), "merkle-leaves")
    nodes = _numbered(leaves, ["id", "node"])
    most = nodes.agg(F.max("n")).first()[0] or 0
    blocks = _climb(nodes, most)
    subroots = blocks.where("block = 0").select("tree", "root")
    forest = _numbered(
        subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"), F.col("tree").alias("item")), ["name"])
    forest = _paths(_climb(forest, forest.agg(F.max("n")).first()[0] or 0))
    forest = forest.select(F.col("item").alias("__tree"), F.col("node").alias("subroot"), F.col("path").alias("__path"), F.col("root").alias("__root"))
    joined = blocks.drop("root").join(forest, F.col("tree") == F.col("__tree"))
    joined = joined.withColumn("above", F.concat("above", "__path")).withColumn("root", F.col("__root")).drop("__tree", "__path", "__root")
    found = _paths(joined)
    return found.select("item.doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", *[F.col("item")[name].alias(name) for name in carried])


def verify(proofs: DataFrame, changed: str) -> DataFrame:
    """Add ``folded_root`` and ``verified``: whether the leaf in column ``changed`` (null: the one on record) leads to the root."""
    again = folded(F.coalesce(F.col(changed), F.col("leaf")), F.col("path"))
    return proofs.withColumn("folded_root", again).withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle(levels: int = 6) -> str:
    """The same in SQL, for trees of up to 16**levels leaves."""
    fields = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)), lambda i: ord(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"
    )
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [f"""
rows AS (SELECT row_number() OVER () AS r, * FROM documents),
leaves AS (SELECT r, doc_id, coalesce('s' || source, '-') AS tree, sha256({fields.format(text='text')}) AS leaf,
    CASE WHEN {crc} % 5 = 0 THEN sha256({fields.format(text=lowered)}) END AS changed FROM rows),
a0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY tree) AS n,
    leaf AS h, r, doc_id, changed FROM leaves)"""]

    def tower(name: str) -> None:
        for k in range(levels):
            parts.append(f"{name}r{k} AS (SELECT tree, p // 16 AS p, any_value(n) AS n, list(h ORDER BY p) AS l FROM {name}{k} WHERE n > {16**k} GROUP BY tree, p // 16)")
            parts.append(f"{name}{k + 1} AS (SELECT tree, p, n, sha256(array_to_string(l, '')) AS h FROM {name}r{k})")

    def root(name: str) -> str:
        return " UNION ALL ".join(
            f"SELECT tree, h FROM {name}{k} WHERE p = 0 AND n <= {16**k}" + (f" AND n > {16 ** (k - 1)}" if k else "") for k in range(levels + 1))

    tower("a")
    parts.append(f"subroots AS ({root('a')})")
    parts.append("b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS p, count(*) OVER () AS n, h, tree AS source FROM subroots)")
    tower("b")
    parts.append(f"root AS ({root('b')})")

    def sides(name: str, rows: str, tree: str, p: str) -> tuple[list[str], list[str], list[str]]:
        joins, proof, fold = [], [], []
        for k in range(levels):
            run = f"{name}x{k}"
            joins.append(f"LEFT JOIN {name}r{k} AS {run} ON {run}.tree = {tree} AND {run}.p = {p} // {16 ** (k + 1)}")
            at = f"({p} // {16**k} % 16)"
            before, after = f"coalesce(array_to_string({run}.l[1:{at}], ''), '')", f"coalesce(array_to_string({run}.l[{at} + 2:], ''), '')"
            proof.append(f"{before} || {after}")
            fold.append(f"CASE WHEN {run}.l IS NULL THEN f{{0}} ELSE sha256({before} || f{{0}} || {after}) END")
        return joins, proof, fold

    left, proof_a, fold_a = sides("a", "a0", "a0.tree", "a0.p")
    right, proof_b, fold_b = sides("b", "b0", "''", "b0.p")
    folds = [f.format(i) for i, f in enumerate(fold_a + fold_b)]
    chain = ["x AS (SELECT a0.doc_id, a0.h AS leaf, b0.h AS subroot, root.h AS root, sha256(" + " || ".join(proof_a + proof_b)
             + ") AS proof_sha256, coalesce(a0.changed, a0.h) AS f0, a0.p AS ap, a0.tree AS at, b0.p AS bp FROM a0 JOIN b0 ON b0.source = a0.tree CROSS JOIN root "
             + " ".join(left + right) + ")"]
    for i, made in enumerate(folds):
        k, name = i % levels, "a" if i < levels else "b"
        tree, p = ("x.at", "x.ap") if i < levels else ("''", "x.bp")
        made = made.replace("a0.p", "x.ap").replace("b0.p", "x.bp")
        source = "x" if not i else f"y{i}"
        made = made.replace("x.", f"{source}.")
        tree, p = tree.replace("x.", f"{source}."), p.replace("x.", f"{source}.")
        run = f"{name}x{k}"
        chain.append(f"y{i + 1} AS (SELECT {source}.* EXCLUDE (f{i}), {made} AS f{i + 1} FROM {source} LEFT JOIN {name}r{k} AS {run} ON {run}.tree = {tree} AND {run}.p = {p} // {16 ** (k + 1)})")
    last = len(folds)
    return "WITH " + ",\n".join(parts + chain) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, f{last} AS folded_root, f{last} = root AS verified FROM y{last}"


@query(_oracle())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against rows of which every fifth is tampered with."""
    docs = table(spark, sf_dir, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, leaf(*values, F.translate("text", UPPER, LOWER)))
    proofs = verify(prove(docs, {"changed": changed}), "changed")
    return proofs.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), "folded_root", "verified")
