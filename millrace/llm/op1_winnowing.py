"""Document fingerprints by winnowing, and how they compare to an edited text and a neighbour's."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import query, table, with_arrays
from .hashing import BASE, BLOCK, Stretches, mixed

GRAM, WINDOW = 24, 40  # any common stretch of GRAM + WINDOW - 1 = 63 characters shares a fingerprint
NEIGHBOURS = 2048  # rows per bucket when documents are laid out in the order of their ids
SENT = 1 << 20  # bucket heads (some 40 bytes each) that are broadcast; more are joined by a shuffle
_POSITIONS = np.uint64(0xFFFFFFFF)


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint32) and positions of the selected grams, in order of position.

    Of every ``window`` consecutive grams of ``gram`` characters the one with
    the least hash is selected, of equal ones the rightmost.  A text with
    fewer grams has one window over all of them; a text shorter than a gram is
    one gram; null and empty texts have none.  Long texts are worked on in
    blocks that overlap by a window, which changes nothing.
    """
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    codes *= np.uint64(BASE)
    codes ^= codes >> np.uint64(29)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    if len(codes) < gram:
        return (Stretches(codes).all(len(codes)) >> np.uint64(32)).astype(np.uint32), np.zeros(1, np.int64)
    hashes, positions = [], []
    for start in range(0, max(1, len(codes) - gram - window + 2), BLOCK):
        values = Stretches(codes[start : start + BLOCK + gram + window - 2]).all(gram)
        # the least of a window is the least hash, then the greatest position
        keys = (values & ~_POSITIONS) | (_POSITIONS - np.arange(len(values), dtype=np.uint64))
        least, size = keys, 1
        wanted = min(window, len(keys))
        while size < wanted:
            step = min(size, wanted - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        chosen = least[np.concatenate(([True], least[1:] != least[:-1]))]
        hashes.append((chosen >> np.uint64(32)).astype(np.uint32))
        positions.append((_POSITIONS - (chosen & _POSITIONS)).astype(np.int64) + start)
    hashes, positions = np.concatenate(hashes), np.concatenate(positions)
    fresh = np.concatenate(([True], positions[1:] != positions[:-1]))  # the last choice of a block may open the next
    return hashes[fresh], positions[fresh]


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; two empty sets are alike."""
    left, right = np.unique(left), np.unique(right)
    both = len(np.intersect1d(left, right, assume_unique=True))
    either = len(left) + len(right) - both
    return both / either if either else 1.0


def written(hashes: np.ndarray, positions: np.ndarray) -> str:
    """``hash@position`` of every selected gram, hash in hex."""
    return " ".join([f"{h:08x}@{p}" for h, p in zip(hashes.tolist(), positions.tolist(), strict=True)])


def fingerprints(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add ``hashes`` and ``positions`` (array<long>) of the winnowed text to every row; nothing is shuffled."""

    def make():
        def run(batch):
            pairs = [winnow(value, gram, window) for value in batch.column(text).to_pylist()]
            return [h.astype(np.int64) for h, _ in pairs], [p for _, p in pairs]

        return run

    return with_arrays(docs, {"hashes": "array<long>", "positions": "array<long>"}, make)


def _bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """Number buckets of about NEIGHBOURS rows in the order of the ids (null ids: -1, the lowest); also their highest count.

    64 quantile cells follow the spread of the ids and equal steps divide each cell,
    so neither clustered nor sparse ids put many rows in one bucket.
    """
    steps = [i / 64 for i in range(1, 64)]
    seen = docs.agg(
        F.count("doc_id").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.percentile_approx("doc_id", steps, 1000).alias("cuts")).first()
    if not seen["n"]:
        return docs.withColumns({"cell": F.lit(-1), "bucket": F.lit(-1).cast("long")}), 1
    borders = sorted({seen["low"], *seen["cuts"]})
    share = max(1, seen["n"] // (len(borders) * NEIGHBOURS))
    lows = F.lit(borders)
    cell = F.size(F.filter(lows, lambda low: low <= F.col("doc_id"))) - 1
    widths = F.lit([float(high - low) for low, high in zip(borders, [*borders[1:], seen["high"] + 1], strict=True)])
    inside = F.floor((F.col("doc_id") - F.get(lows, F.col("cell"))) / F.get(widths, F.col("cell")) * share)
    return (
        docs.withColumn("cell", F.when(F.col("doc_id").isNull(), -1).otherwise(cell))
        .withColumn("bucket", F.when(F.col("cell") < 0, -1).otherwise(
            F.col("cell") * F.lit(share).cast("long") + F.least(F.lit(share - 1).cast("long"), inside)))
    ), len(borders) * share + 1


def beside_next(docs: DataFrame) -> DataFrame:
    """Lay (doc_id, text) out so that each row is followed by the next in descending order of ids.

    Result: doc_id, text, bucket, border; partitions hold whole buckets in descending order.
    After its rows each bucket has one border row, a copy of the first row of
    the following bucket (after the last bucket: of the first).  Equal ids are
    ordered by the hash of their texts.  Texts are shuffled once.
    """
    keyed, buckets = _bucketed(docs.select("doc_id", "text"))
    keyed = keyed.withColumn("tie", F.xxhash64("text"))
    heads = keyed.groupBy("cell", "bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    # the following bucket of each: inside its cell, else the first of the next cell (at most 65 cells)
    order = Window.partitionBy("cell").orderBy(F.desc("bucket"))
    firsts = heads.groupBy("cell").agg(F.max_by("head", "bucket").alias("first"))
    around = firsts.select("cell", F.coalesce(
        F.lead("first").over(Window.orderBy(F.desc("cell"))), F.first("first").over(Window.orderBy(F.desc("cell")))).alias("after"))
    links = (
        heads.withColumn("inner", F.lead("head").over(order)).join(around, "cell")
        .select(F.col("bucket").alias("to"), F.coalesce("inner", "after").alias("next"))
        .select("to", F.coalesce("next.doc_id", F.lit(0)).alias("next_id"), F.col("next.doc_id").isNull().alias("next_null"), F.col("next.tie").alias("tie"))
    )
    keyed = keyed.withColumns({"next_id": F.coalesce("doc_id", F.lit(0)), "next_null": F.col("doc_id").isNull()})
    borders = (
        keyed.join(F.broadcast(links) if buckets <= SENT else links, ["next_id", "next_null", "tie"])
        .select("doc_id", "text", F.col("to").alias("bucket"), F.lit(True).alias("border"), "tie")
    )
    rows = keyed.select("doc_id", "text", "bucket", F.lit(False).alias("border"), "tie")
    return (
        rows.unionByName(borders).repartition("bucket")
        .sortWithinPartitions(F.desc("bucket"), "border", F.desc_nulls_last("doc_id"), F.desc("tie"))
        .select("doc_id", "text", "bucket", "border")
    )


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by as many first ones of the following text."""
    count = len(text) // 3
    return text[: len(text) - count] + following[:count]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    waiting = None  # the row that still needs its next one
    for batch in batches:
        rows = []
        for doc_id, text, bucket, border in zip(batch["doc_id"], batch["text"], batch["bucket"], batch["border"], strict=True):
            text = text or ""
            here = winnow(text)
            if waiting is not None and waiting[3] == bucket:
                own_id, own_text, own, _ = waiting
                changed = edited(own_text, text)
                marks = winnow(changed)
                rows.append((
                    own_id, len(own_text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), written(*own),
                    written(*marks), likeness(own[0], marks[0]), likeness(own[0], here[0])))
            waiting = None if border else (None if pd.isna(doc_id) else int(doc_id), text, here, bucket)
        out = pd.DataFrame(rows, columns=[part.split()[0] for part in RESULT.split(", ")])
        yield out.astype({"doc_id": "Int64"})


@query()
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text; compare with both neighbours."""
    return beside_next(table(spark, sf_dir, "documents")).mapInPandas(_compare, RESULT)
