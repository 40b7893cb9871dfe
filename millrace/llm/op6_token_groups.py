"""N-gram Jaccard join with a token-group matrix."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import staged

from .base import query, release, table, with_arrays
from .components import components
from .hashing import BASE, mixed, shingles, word_hashes

WIDTH = 5  # words of a shingle
GROUP = 256  # expected most documents of a group
SHARED = 3  # index tokens that linked sets share, if they are large enough
FAMILY = 2  # frequency class from which an index token names the group of its documents
SLOTS = 20  # 2**20 counters (1 MB) tell frequent shingles from rare ones
PILE = 1 << 21  # shingles a task counts at once
SENT = 1_000_000  # keys (some 50 bytes each) that are broadcast; more are joined by a shuffle
_SALT = np.uint64(0xA0761D6478BD642F)


def token_set(text: str | None) -> tuple[bytes | None, np.ndarray]:
    """Key of the word sequence (null without words) and the sorted distinct shingles."""
    words = word_hashes(text)
    if not len(words):
        return None, words
    return hashlib.md5(words.tobytes()).digest(), shingles(words, WIDTH)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per document, and now and then one with the counts of shingles met three times or more."""
    pile, seen, size = [], set(), 0

    def counted() -> pd.DataFrame:
        values, counts = np.unique(np.concatenate(pile), return_counts=True)
        often = counts >= 3
        slots = (values[often] >> np.uint64(64 - SLOTS)).astype(np.int32)
        return pd.DataFrame({"slots": [slots.tobytes()], "counts": [counts[often].astype(np.int32).tobytes()]})

    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            key, tokens = token_set(text)
            rows.append((None if pd.isna(doc_id) else int(doc_id), key, len(tokens)))
            if key is not None and key not in seen:
                seen.add(key)
                pile.append(tokens)
                size += len(tokens)
            if size > PILE:
                yield counted().reindex(columns=["doc_id", "key", "n_shingles", "slots", "counts"]).astype({"doc_id": "Int64", "n_shingles": "Int64"})
                pile, seen, size = [], set(), 0
        out = pd.DataFrame(rows, columns=["doc_id", "key", "n_shingles"]).astype({"doc_id": "Int64", "n_shingles": "Int64"})
        yield out.assign(slots=None, counts=None)
    if pile:
        yield counted().reindex(columns=["doc_id", "key", "n_shingles", "slots", "counts"]).astype({"doc_id": "Int64", "n_shingles": "Int64"})
    del pile, seen
    release()


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for slots, counts in zip(batch["slots"], batch["counts"], strict=True):
            yield pd.DataFrame({"slot": np.frombuffer(slots, np.int32), "n": np.frombuffer(counts, np.int32)})


def frequency_classes(members: DataFrame) -> np.ndarray:
    """For every counter the binary logarithm of how often its shingles were met; 0 for rare ones.

    The classes only order shingles.  Any order gives the same links; this one
    keeps shingles that many documents share out of the index.
    """
    counts = members.where("slots IS NOT NULL").select("slots", "counts").mapInPandas(_unpacked, "slot int, n int")
    found = counts.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # at most 2**SLOTS rows
    classes = np.zeros(1 << SLOTS, np.uint8)
    classes[found["slot"].to_numpy(int)] = np.log2(found["n"].to_numpy(float)).astype(np.uint8)
    return classes


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The row of the matrix: hashed token columns, about two per token, a power of two, as bits."""
    columns = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    bits = np.zeros(columns, bool)
    bits[(tokens & np.uint64(columns - 1)).astype(np.int64)] = True
    return bits


def folded(bits: np.ndarray, columns: int) -> np.ndarray:
    """The same row over fewer columns."""
    while len(bits) > columns:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def misses(own: np.ndarray, other: np.ndarray) -> int:
    """Columns of one row that the other does not have: at least so many tokens are not shared."""
    columns = min(len(own), len(other))
    return int((folded(own, columns) & ~folded(other, columns)).sum())


def needed(size: int, percent: int) -> int:
    """Index tokens that a linked set of any size must share with a set of this size."""
    return max(1, min(SHARED, -(-percent * size // 100)))


def _index_row(tokens: np.ndarray, classes: np.ndarray, percent: int) -> tuple[list[int], int, int, bytes]:
    """Index tokens, the two parts of the group's name, and the matrix row of one token set.

    Index tokens are the rarest ones: of n tokens n - ceil(t * n) + s, so that linked sets share s of
    them (``needed``; the smaller s of two sets counts).  If even they are frequent, most of the
    document is shared by a family of documents, and the first token of their
    most frequent class names the group: nearly all of the family agree in it.
    All others are named by two min-hashes.
    """
    size = len(tokens)
    often = classes[(tokens >> np.uint64(64 - SLOTS)).astype(np.int64)]
    order = np.lexsort((tokens, often))[: size - -(-percent * size // 100) + needed(size, percent)]
    if often[order[-1]] >= FAMILY:
        first, second = tokens[order[np.searchsorted(often[order], often[order[-1]])]], np.uint64(0)
    else:
        first, second = tokens.min(), mixed(tokens * np.uint64(BASE) ^ _SALT).min()
    return tokens[order].astype(np.int64).tolist(), int(first.astype(np.int64)), int(second.astype(np.int64)), np.packbits(bitmap(tokens)).tobytes()


def _bits(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)


def union_of(rows: list[bytes]) -> bytes:
    """The matrix row of a group: the union of its members' tokens, over the columns of the smallest."""
    bits = [_bits(r) for r in rows]
    columns = min(map(len, bits))
    return np.packbits(np.logical_or.reduce([folded(b, columns) for b in bits])).tobytes()


def most_shared(size: int, own: np.ndarray, union: np.ndarray) -> int:
    """A bound on the tokens that a set of this size and matrix row shares with any set of the group."""
    return size - misses(own, union)


def _qualifying(mine: list[dict], union: bytes, low: int, high: int, percent: int) -> list[bytes]:
    """The documents that a group's token union, and its sizes from low to high, still allow to have a partner there."""
    other, kept = _bits(union), []
    for m in mine:
        if 100 * min(m["n"], high) < percent * max(m["n"], low):
            continue
        if 100 * most_shared(m["n"], _bits(m["bits"]), other) >= percent * max(m["n"], low):
            kept.append(m["key"])
    return kept


def _least_shared(percent: int) -> str:
    """SQL for how many index tokens two groups must share, given ``g_low``, ``g_high``, ``h_low`` and ``h_high``, if any of their documents are linked.

    Linked sets of a and b tokens share t / (1 + t) * (a + b) or more.  All of them
    but those beyond the last index token of one set, at most ceil(t * n) - s, are index tokens of both.
    That number falls with the smaller and grows with the larger set, so the extreme sizes of the groups give the least.
    """
    s = f"least({SHARED}, ceil({percent} * least(g_low, h_low) / 100D))"
    least = ", ".join(
        f"{percent}D * ({x} + {y}) / {100 + percent} - {percent}D * greatest({x}, {y}) / 100" for x, y in (("g_low", "h_high"), ("g_high", "h_low")))
    return f"greatest({s}, {s} - 1 + ceil(least({least}) - 1e-6))"


def _links(keys: list[bytes], sets: list[np.ndarray], sides: list[int], percent: int) -> list[tuple[bytes, bytes]]:
    """Links between documents of side 0 and side 1 (all pairs if there is one side): enough to connect what is linked."""
    parent = list(range(len(keys)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    one_side = len(set(sides)) == 1
    flat, starts = np.concatenate(sets), np.concatenate(([0], np.cumsum(sizes)[:-1]))
    found = []
    for i, own in enumerate(sets):
        if not one_side and sides[i]:
            continue
        at = np.searchsorted(own, flat)
        at[at == len(own)] = 0
        shared = np.add.reduceat(own[at] == flat, starts, dtype=np.int64)
        linked = 100 * shared >= percent * (sizes + sizes[i] - shared)
        for j in np.flatnonzero(linked):
            if i != j and (one_side or sides[j]) and root(i) != root(int(j)):
                parent[root(i)] = root(int(j))
                found.append((keys[i], keys[int(j)]))
    return found


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, ``n_shingles`` and ``component_id`` of every row of (doc_id, text).

    Two documents are linked when 100 * shared >= percent * united shingles; a
    component is named by the least doc_id in it.  Rows without words are empty,
    linked with nothing and their own component; null ids and repeated rows stay.

    1. Equal word sequences are one class; only its first row goes on.
    2. Classes that agree in a frequent index token, or else in two min-hashes,
       form a group, cut by a hash into parts of about ``GROUP``.  A group's row of the token-group matrix is the
       union of its tokens over hashed columns.
    3. Groups meet on index tokens: of each set the first in
       an order from rare to frequent, some of which linked sets must share (``needed``).  How many two groups
       share bounds the overlap of their documents: what is not among the index tokens of both is beyond
       the last index token of one of them.
    4. The stored matrix bounds the overlap of each document with the other group's union, first
       on the row of the group alone; members of a group are fetched for pairs that pass.
       Only groups that pass are opened, and exact sets decide.  Of the links in
       a pair of groups a spanning forest is kept.
    5. Links become components.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    members = staged(docs.mapInPandas(_members, "doc_id long, key binary, n_shingles long, slots binary, counts binary"), "members")
    classes = spark.sparkContext.broadcast(frequency_classes(members))  # 2**SLOTS bytes
    members = members.where("slots IS NULL").select("doc_id", "key", "n_shingles")
    firsts = members.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    copies = (
        members.join(firsts.select("key", F.coalesce("doc_id", F.lit(-1)).alias("first")), "key")
        .where(F.coalesce("doc_id", F.lit(-1)) != F.col("first"))
        .select("key", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"))
    )

    def index():
        def run(batch):
            keys, rows = [], []
            for text in batch.column("text").to_pylist():
                key, tokens = token_set(text)
                keys.append(key)
                rows.append(_index_row(tokens, classes.value, percent) + (len(tokens),) if key else (None,) * 5)
            return keys, *zip(*rows, strict=True)

        return run

    rows = with_arrays(docs, {"key": "binary", "tokens": "array<long>", "first": "long", "second": "long", "bits": "binary", "n": "int"}, index, dropped=("text",))
    rows = rows.where("key IS NOT NULL").withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    sent = F.broadcast if copies.count() <= SENT else (lambda df: df)
    rows = staged(rows.join(sent(copies), ["key", "doc_id"], "left_anti"), "index")
    sizes = rows.select("key", "first", "second").distinct().groupBy("first", "second").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / GROUP)
    grouped = rows.join(sizes, ["first", "second"]).withColumn("group", F.xxhash64("first", "second", F.pmod(F.xxhash64("key"), parts)))
    # (token, group) index and the candidate pairs of groups
    # dealt by token once: that serves the removal of repeats and both sides of the join
    entries = grouped.select("group", F.explode("tokens").alias("token")).repartition("token").distinct()
    left, right = entries.withColumnRenamed("group", "g"), entries.withColumnRenamed("group", "h")
    pairs = left.join(right, "token").where("g < h").groupBy("g", "h").agg(F.count("*").alias("shared"))
    members_of = grouped.groupBy("group").agg(F.collect_set(F.struct("key", "n", "bits")).alias("members"))  # about GROUP of them

    def united():
        return lambda batch: ([union_of([m["bits"] for m in members]) for members in batch.column("members").to_pylist()],)

    matrix = members_of.withColumns({"low": F.array_min("members.n"), "high": F.array_max("members.n"), "count": F.size("members")})
    matrix = staged(with_arrays(matrix, {"union": "binary"}, united), "group-matrix")
    alone = matrix.where(F.col("count") > 1).select(F.col("group").alias("g"), F.col("group").alias("h"))
    sizes_of = lambda name, own: matrix.select(F.col("group").alias(name), F.col("low").alias(f"{own}_low"), F.col("high").alias(f"{own}_high"))
    pairs = pairs.join(sizes_of("g", "g"), "g").join(sizes_of("h", "h"), "h")
    # sizes allow a link, and so do the shared index tokens
    pairs = pairs.where(f"100 * least(g_high, h_high) >= {percent} * greatest(g_low, h_low) AND shared >= {_least_shared(percent)}")
    pairs = staged(pairs, "group-pairs")

    def bound_rows():
        def run(batch):
            names = [f"{own}_{name}" for own in "gh" for name in ("count", "low", "high", "union")]
            found = []
            for g_count, g_low, g_high, g, h_count, h_low, h_high, h in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                g, h = _bits(g), _bits(h)
                # the row of a single document bounds its overlap; that of several together does not
                left = g_count > 1 or 100 * most_shared(g_high, g, h) >= percent * max(g_high, h_low)
                right = h_count > 1 or 100 * most_shared(h_high, h, g) >= percent * max(h_high, g_low)
                found.append(left and right)
            return (found,)

        return run

    union = lambda name, own: matrix.select(F.col("group").alias(name), F.col("count").alias(f"{own}_count"), F.col("union").alias(f"{own}_union"))
    rows_met = pairs.join(union("g", "g"), "g").join(union("h", "h"), "h")
    passed = with_arrays(rows_met.drop("shared"), {"open": "boolean"}, bound_rows, dropped=tuple(f"{own}_{name}" for own in "gh" for name in ("count", "low", "high", "union")))
    passed = staged(passed.where("open").select("g", "h"), "bounded-pairs")
    side = lambda name, own: matrix.select(F.col("group").alias(name), F.struct("members", "union", "low", "high").alias(own))
    pairs = passed.union(alone).join(side("g", "mine"), "g").join(side("h", "others"), "h")

    def bound():
        def run(batch):
            lefts, rights = [], []
            for g, h, mine, others in zip(*(batch.column(c).to_pylist() for c in ("g", "h", "mine", "others")), strict=True):
                keys = _qualifying(mine["members"], others["union"], others["low"], others["high"], percent)
                chosen = [m for m in mine["members"] if m["key"] in set(keys)]
                back = []
                if g != h and chosen:
                    sizes = [m["n"] for m in chosen]
                    back = _qualifying(others["members"], union_of([m["bits"] for m in chosen]), min(sizes), max(sizes), percent)
                lefts.append(keys if g == h or back else [])
                rights.append(back)
            return lefts, rights

        return run

    opened = with_arrays(pairs, {"left": "array<binary>", "right": "array<binary>"}, bound, dropped=("mine", "others"))
    opened = staged(opened.where("size(left) > 0"), "opened-groups")
    wanted = (
        opened.select("g", "h", F.lit(0).alias("side"), F.explode("left").alias("key"))
        .union(opened.select("g", "h", F.lit(1), F.explode("right")))
    )
    sent = F.broadcast if wanted.count() <= SENT else (lambda df: df)
    ids = firsts.join(wanted.select("key").distinct(), "key")
    ids = ids.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), F.col("key").alias("want"))
    full = docs.withColumn("id", F.coalesce("doc_id", F.lit(-1))).join(sent(ids), "id")

    def sets():
        def run(batch):
            found = [token_set(text) for text in batch.column("text").to_pylist()]
            return [key for key, _ in found], [tokens.tobytes() for _, tokens in found]

        return run

    full = with_arrays(full, {"key": "binary", "set": "binary"}, sets, dropped=("text", "doc_id", "id"))
    full = full.where("key = want").select("key", "set")

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["side", "key"]).sort_values(["side", "key"])  # repeated rows of a document
        found = _links(list(rows["key"]), [np.frombuffer(s, np.uint64) for s in rows["set"]], list(rows["side"]), percent)
        return pd.DataFrame(found, columns=["u", "v"])

    # a group of this is the documents of two groups of documents, about 2 * GROUP
    links = full.join(sent(wanted), "key").groupBy("g", "h").applyInPandas(verify, "u binary, v binary")
    reached = components(links)
    named = firsts.join(reached.withColumnRenamed("node", "key"), "key").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    roots = reached.join(named, "root").select(F.col("node").alias("key"), "component_id")
    by_class = firsts.join(roots, "key", "left").select("key", F.coalesce("component_id", "doc_id").alias("component_id"))
    return members.join(by_class, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each component stays: that of the least doc_id, null ids last; of equal ids one of those rows.

    Rows are told apart by a number of their own, so null and repeated ids are grouped like others,
    a repeated row goes, and a row that shares the id of a dropped one stays.
    Rows without words all stay.  The rows are stored once with their numbers.
    """
    row = "__row"
    while row in docs.columns:
        row += "_"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    found = staged(near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), percent), "near-duplicates")
    grouped = found.where("doc_id <> component_id").select("component_id").distinct()
    members = found.join(grouped, "component_id", "left_semi").select(F.col("doc_id").alias(row), "component_id")
    ids = members.join(rows.select(row, F.col("doc_id").cast("long").alias("id")), row)
    order = F.struct(F.col("id").isNull().alias("none"), "id", row)
    first = ids.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col(f"first.{row}").alias(row))
    gone = staged(members.select(row).join(first, row, "left_anti"), "dropped-rows")
    return rows.join(F.broadcast(gone) if gone.count() <= SENT else gone, row, "left_anti").drop(row)


@query()
def op6_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
