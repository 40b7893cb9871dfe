"""Line dedup: a sharded minimal perfect hash over the distinct lines, probed by the documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import staged

from .base import query, table, with_arrays
from .hashing import mixed

LEAST = 10  # documents that make a line a repeated one
SHARD_LINES = 1 << 17  # lines a shard is planned for
SENT_BYTES = 1 << 26  # an index up to this size goes to every task; a larger one is met shard by shard
PART_BYTES = 1 << 26  # digests that meet one shard in one task
PILE_BITS = 10  # consecutive rows that ask together: 2**PILE_BITS
SPACE = b" \t\n\x0b\x0c\r"
_GOLD = 0x9E3779B97F4A7C15
DIGEST = 16  # bytes
INDEX = "shard long, sizes binary, bits binary, tags binary, counts binary"


def line_digests(text: str | None) -> list[bytes]:
    """One digest per line of the text, of its key; b'' for a line without a key.  A null text is one empty line."""
    keys = [line.strip(SPACE).lower() for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]
    return [blake2b(key, digest_size=DIGEST).digest() if key else b"" for key in keys]


def _numbers(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, np.uint64).reshape(-1, 2)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys[:, 1] + np.uint64((level + 1) * _GOLD % 2**64)) % np.uint64(size)).astype(np.int64)


class Shard:
    """A minimal perfect hash: slot number, tag and count of every key it was built from.

    Keys that hash alone into a bit of a level stay there, the others go on to the
    next, smaller level.  The slot is the number of bits set before the key's
    bit, so n keys fill the slots 0 to n - 1 and the keys themselves are not kept.
    Some 4 bits per key, with the tag (2 bytes) that tells most foreign keys
    apart, and the count, which stops at ``most``.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, tags: np.ndarray, counts: np.ndarray):
        self.sizes, self.bits, self.tags, self.counts = sizes, bits, tags, counts
        self.slots = np.cumsum(bits, dtype=np.int32) - 1

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, most: int) -> Shard:
        """``keys``: distinct rows of two 64-bit numbers; their order does not matter."""
        sizes, levels, left = [], [], keys
        while len(left):
            size = 2 * len(left) + 1
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            left = left[~alone[at]]
        shard = cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, bool), *levels]), None, None)
        slots = shard.find(keys)
        shard.tags, shard.counts = np.zeros(len(keys), np.uint16), np.zeros(len(keys), np.uint8 if most < 256 else np.uint32)
        shard.tags[slots] = keys[:, 0].astype(np.uint16)
        shard.counts[slots] = np.minimum(counts, most)
        return shard

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for a key the shard was not built from."""
        found = np.full(len(keys), -1, np.int64)
        open_, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + _place(keys[open_], level, size)
            hit = self.bits[at]
            found[open_[hit]] = self.slots[at[hit]]
            open_, start = open_[~hit], start + size
        return found

    def count(self, keys: np.ndarray) -> np.ndarray:
        """In how many documents each line was found (up to ``most``), 0 for lines whose tag differs."""
        slots = self.find(keys)
        known = slots >= 0
        known[known] = self.tags[slots[known]] == keys[known, 0].astype(np.uint16)
        result = np.zeros(len(keys), np.int64)
        result[known] = self.counts[slots[known]]
        return result

    def packed(self) -> tuple[bytes, bytes, bytes, bytes]:
        return self.sizes.tobytes(), np.packbits(self.bits).tobytes(), self.tags.tobytes(), self.counts.tobytes()

    @classmethod
    def unpacked(cls, sizes: bytes, bits: bytes, tags: bytes, counts: bytes) -> Shard:
        sizes, tags = np.frombuffer(sizes, np.int64), np.frombuffer(tags, np.uint16)
        flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes.sum())).astype(bool)
        return cls(sizes, flags, tags, np.frombuffer(counts, np.uint8 if len(counts) == len(tags) else np.uint32))


def _shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys[:, 0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _counted(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct lines of some documents and in how many of them each is."""
    counts: Counter = Counter()
    for text in texts:
        counts.update({d for d in line_digests(text) if d})
    return _numbers(b"".join(counts)), np.fromiter(counts.values(), np.int64, len(counts))


def _count_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keys, counts = _counted(batch["text"])
        yield pd.DataFrame({"hi": keys[:, 0].astype(np.int64), "lo": keys[:, 1].astype(np.int64), "n": counts})


def line_index(docs: DataFrame, least: int = LEAST, shard_lines: int = SHARD_LINES) -> tuple[DataFrame, int]:
    """The index over all distinct lines of ``text``, one row per shard, and the bits of a shard's number.

    Counts of a batch of documents are added up before and after the shuffle, so
    a line that is everywhere is one row per batch at most.  Shards are cut by
    digest, which spreads lines evenly, and hold about ``shard_lines`` of them.
    Counts stop at 255, or above that where ``least`` is greater.
    """
    most = max(255, least)
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    bits = max(0, (lines // shard_lines).bit_length())

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows[["hi", "lo"]].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame([(rows["shard"].iloc[0], *Shard.of(keys, rows["n"].to_numpy(), most).packed())], columns=["shard", "sizes", "bits", "tags", "counts"])

    counts = docs.select("text").mapInPandas(_count_lines, "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))
    shard = F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0).cast("long")
    return staged(counts.withColumn("shard", shard).groupBy("shard").applyInPandas(build, INDEX), "line-index"), bits


def _without(text: str | None, digests: list[bytes], repeated: list[bool]) -> tuple[str | None, int, int]:
    """The text without its repeated lines, its lines, and how many were dropped."""
    dropped = sum(repeated)
    if not dropped:
        return text, len(digests), 0
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    return b"\n".join(line for line, gone in zip(lines, repeated, strict=True) if not gone).decode("utf-8", "surrogatepass"), len(digests), dropped


def _answers(texts: list[str | None], repeated) -> tuple[list, list, list]:
    """Columns of the result; ``repeated(keys)`` tells which of the distinct lines are to go."""
    digests = [line_digests(text) for text in texts]
    distinct = sorted({d for own in digests for d in own if d})
    gone = {d for d, hit in zip(distinct, repeated(_numbers(b"".join(distinct))), strict=True) if hit}
    found = [_without(text, own, [d in gone for d in own]) for text, own in zip(texts, digests, strict=True)]
    return [f[1] for f in found], [f[2] for f in found], [f[0] for f in found]


def drop_repeated_lines(docs: DataFrame, least: int = LEAST, sent_bytes: int = SENT_BYTES, part_bytes: int = PART_BYTES, shard_lines: int = SHARD_LINES) -> DataFrame:
    """All rows and columns of ``docs``; ``text`` loses the lines that ``least`` documents or more have.

    Lines end at line feeds.  Two lines are equal if they are so without spaces, tabs
    and line breaks at both ends and in lower case (A-Z).  Empty lines stay, as
    do all lines below ``least``; a repeated line goes in every document.  Adds
    ``n_lines`` (before) and ``n_dropped``; columns of these names are replaced.

    Each row is a document, also with a null or a repeated id.  A null text stays
    null and counts as one empty line.  An empty table gives no rows.

    The index is as large as the distinct lines need (4 bytes each).  While it has
    at most ``sent_bytes``, every task gets it and no document moves.  A larger
    one is met shard by shard: piles of rows ask each shard for their distinct
    lines, so a line that is everywhere is asked for once per pile; a shard that
    is asked for too much meets the askers in several tasks.
    """
    index, bits = line_index(docs, least, shard_lines)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")])
    size = index.agg(F.sum(F.octet_length("bits") + F.octet_length("tags") + F.octet_length("counts") + F.octet_length("sizes"))).first()[0] or 0
    if size > sent_bytes:
        return _shard_by_shard(docs, index, bits, least, part_bytes)
    sent = docs.sparkSession.sparkContext.broadcast([tuple(row) for row in index.collect()])  # sent_bytes at most

    def make():
        shards = {row[0]: Shard.unpacked(*map(bytes, row[1:])) for row in sent.value}

        def repeated(keys: np.ndarray) -> np.ndarray:
            own, hits = _shard_of(keys, bits), np.zeros(len(keys), bool)
            for shard in np.unique(own).tolist():
                hits[own == shard] = shards[shard].count(keys[own == shard]) >= least
            return hits

        return lambda batch: _answers(batch.column("text").to_pylist(), repeated)

    return with_arrays(docs, {"n_lines": "long", "n_dropped": "long"}, make, replaced=("text",))


def _shard_by_shard(docs: DataFrame, index: DataFrame, bits: int, least: int, part_bytes: int) -> DataFrame:
    # stored, so that a row's pile is the same whenever it is read
    rows = staged(docs.withColumn("__pile", F.shiftright(F.monotonically_increasing_id(), PILE_BITS)), "line-piles")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for pile, texts in batch.groupby("pile")["text"]:
                keys, _ = _counted(texts)
                own = _shard_of(keys, bits)
                out += [(shard, pile, keys[own == shard].tobytes()) for shard in np.unique(own).tolist()]
            yield pd.DataFrame(out, columns=["shard", "pile", "keys"])

    asked = staged(rows.select(F.col("__pile").alias("pile"), "text").mapInPandas(ask, "shard long, pile long, keys binary"), "line-questions")
    parts = asked.groupBy("shard").agg(F.ceil(F.sum(F.octet_length("keys")) / part_bytes).alias("parts"))
    left = asked.join(parts, "shard").selectExpr("shard", "pmod(xxhash64(pile), parts) AS part", "pile", "keys")
    right = index.join(parts, "shard").selectExpr("shard AS own", "explode(sequence(0L, parts - 1)) AS own_part", "sizes", "bits", "tags", "counts")

    def probe(questions: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        if not len(questions) or not len(shards):
            return pd.DataFrame({"pile": [], "gone": []})
        row = shards.iloc[0]
        shard = Shard.unpacked(*map(bytes, row[["sizes", "bits", "tags", "counts"]]))
        found = ((pile, k[shard.count(k) >= least].tobytes()) for pile, k in ((p, _numbers(bytes(k))) for p, k in zip(questions["pile"], questions["keys"], strict=True)))
        return pd.DataFrame([f for f in found if f[1]], columns=["pile", "gone"])

    gone = left.groupBy("shard", "part").cogroup(right.groupBy("own", "own_part")).applyInPandas(probe, "pile long, gone binary")
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL("n_lines long, n_dropped long").fields])
    arrow = to_arrow_schema(schema)

    def cut(pile: pa.Table, answers: pa.Table) -> pa.Table:
        known = {blob[at : at + DIGEST] for blob in answers.column("gone").to_pylist() for at in range(0, len(blob), DIGEST)}
        values = dict(zip(("n_lines", "n_dropped", "text"), _answers(pile.column("text").to_pylist(), lambda keys: [k.tobytes() in known for k in keys]), strict=True))
        return pa.table([pa.array(values[f.name], f.type) if f.name in values else pile.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return rows.groupBy("__pile").cogroup(gone.withColumnRenamed("pile", "__pile").groupBy("__pile")).applyInArrow(cut, schema)


OP13_SQL = r"""
WITH lines AS (
    SELECT r, doc_id, unnest(list_transform(parts, lambda line, i: {'i': i, 'line': line})) AS x
    FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
    SELECT r, doc_id, x.i AS i, x.line AS line,
           translate(trim(x.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE often.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often USING (key) GROUP BY r, doc_id
"""


@query(OP13_SQL)
def op13_line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten or more of them share."""
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
