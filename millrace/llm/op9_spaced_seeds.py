"""Benchmark decontamination by spaced seeds: hashes that ignore some token positions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import staged

from .base import query, release, table
from .hashing import BASE, MARKS, mixed, word_hashes

#: Which of the tokens in a row count (1) and which may differ (0); six count in each mask.  Chosen by enumeration: one of them
#: fits somewhere in every stretch of 13 tokens with 2 that differ, 15 with 3, 20 with 4 and 25 with 5.  Every stretch of at least
#: ``LEAST`` tokens of which ``SAME`` are equal holds one of these: 26 and more can be halved, the rest holds a shorter one.
MASKS = ("1100101011", "11110011", "1100100000111")
SPAN = max(map(len, MASKS))
BITS = 24  # the filter in front of the join has 2**24 bits, 2 MB, whatever the benchmark
AROUND = 128  # tokens kept on each side of a hit for the comparison
LEAST = 13  # tokens an overlap must span
SENT = 1_000_000  # ids that are broadcast; more are joined by a shuffle
SAME = 0.8  # and the share of them that must be equal
HIT = "text_key long, cluster int, start int, tokens binary, hits array<struct<hash: long, at: int, step: int, times: int>>"


def tokens_of(text: str | None) -> np.ndarray:
    """Token hashes: runs of letters and digits, lower-cased; punctuation separates."""
    return word_hashes((text or "").lower(), MARKS)


def whole_masks(length: int) -> list[str]:
    """Masks over a whole item of ``length`` < ``SPAN`` tokens, one of which fits whichever tokens differ as ``SAME`` allows.

    The tokens are cut into groups, three more than may differ, and every choice of as many groups as tokens is left out.
    """
    differ = length - -(-length * round(SAME * 1000) // 1000)
    groups = np.array_split(np.arange(length), differ + 3 if differ else 1)
    return ["".join("01"[at not in out] for at in range(length)) for gone in combinations(groups, differ) for out in [set(np.concatenate([[-1], *gone]).tolist())]]


def masks_for(lengths: list[int]) -> list[tuple[int, str]]:
    """Numbered masks for items of these lengths; any length from ``SPAN`` on stands for all of them."""
    found = list(enumerate(MASKS, 1)) if any(n >= SPAN for n in lengths) else []
    return found + [(n << 16 | at, mask) for n in sorted({n for n in lengths if n < SPAN}) for at, mask in enumerate(whole_masks(n))]


def seeds(tokens: np.ndarray, masks: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of every mask at every place of the token sequence; of a hash without gaps over a short item the first place."""
    hashes, places = [], []
    for number, mask in masks:
        count = len(tokens) - len(mask) + 1
        if count <= 0:
            continue
        total = np.full(count, number, np.uint64)
        for at, used in enumerate(mask):
            if used == "1":
                total *= np.uint64(BASE)
                total += tokens[at : at + count]
        if number >> 16 and "0" not in mask:  # a fit is the whole item, so one is enough
            total, first = np.unique(total, return_index=True)
            places.append(first)
        else:
            places.append(np.arange(count))
        hashes.append(mixed(total))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def strides(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal hashes at places of equal distance as one entry: hash, first place, distance (0 if alone), number of places.

    So a repeated token or pattern is a few entries, however long it goes on.
    """
    order = np.lexsort((places, hashes))
    hashes, places = hashes[order], places[order]
    if not len(hashes):
        return hashes, places, places, places
    same = hashes[1:] == hashes[:-1]
    gap = np.where(same, np.diff(places), 0)  # to the next place of the hash; 0 at its last
    starts = [0]
    at = 0
    change = np.flatnonzero((gap[1:] != gap[:-1]) | ~same[1:]) + 1 if len(gap) else np.zeros(0, int)
    change = np.append(change, len(gap))
    while at < len(hashes) - 1:  # an entry goes on while the distance stays the same
        if not gap[at]:
            at += 1
        else:
            at = int(change[np.searchsorted(change, at, side="right")]) + 1
        if at < len(hashes):
            starts.append(at)
    starts = np.array(starts)
    times = np.diff(np.append(starts, len(hashes)))
    step = np.where(times > 1, np.append(gap, 0)[starts], 0)
    return hashes[starts], places[starts], step, times


#: All differences of a place of the document and one of the item, for two entries with the same hash
SHIFTS = """
    CASE WHEN step = item_step OR times = 1 OR item_times = 1
         THEN sequence(at - item_at - (item_times - 1) * item_step, at - item_at + (times - 1) * step, greatest(step, item_step, 1))
         ELSE flatten(transform(sequence(0, times - 1), i -> transform(sequence(0, item_times - 1), j -> at + i * step - item_at - j * item_step))) END
"""


def _item_seeds(shortest: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item_id, text in zip(batch["item_id"], batch["text"], strict=True):
                tokens = tokens_of(text)
                hashes, places = seeds(tokens, masks_for([len(tokens)]) if len(tokens) >= max(1, shortest) else [])
                hashes, first, step, times = strides(hashes, places)
                columns = {"item_at": first, "item_step": step, "item_times": times}
                yield pd.DataFrame({"item_id": item_id, "hash": hashes.astype(np.int64), **{name: c.astype(np.int32) for name, c in columns.items()}})

    return run


def _item_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"item_id": batch["item_id"], "item_tokens": [tokens_of(t).tobytes() for t in batch["text"]]})


def longest_overlap(equal: np.ndarray, same: float) -> tuple[int, int]:
    """Start and length of the longest stretch in which at least ``same`` of the positions are equal (first of ties)."""
    scale = 1000
    sums = np.concatenate(([0], np.cumsum(np.where(equal, scale, 0) - round(same * scale))))
    # a start can only be a new least sum, an end only a greatest one of what follows
    lowest = np.minimum.accumulate(sums)
    highest = np.maximum.accumulate(sums[::-1])[::-1]
    # for every start the last end whose sum is not below it; starts with falling sums suffice
    starts = np.flatnonzero(np.concatenate(([True], lowest[1:] < lowest[:-1])))
    ends = np.searchsorted(-highest, -sums[starts], side="right") - 1
    best = int(np.argmax(ends - starts))
    return int(starts[best]), int(ends[best] - starts[best])


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, same: float = SAME, shortest: int = 1) -> DataFrame:
    """The overlaps of documents (doc_id, text) with benchmark items (item_id, text).

    One row per document and item that overlap: doc_id, item_id, ``doc_start``
    and ``item_start`` (token numbers), ``n_tokens`` that the overlap spans and
    ``n_equal`` of them.  Substituted tokens are tolerated: around every place
    where a mask fits both sides, the sequences are compared token by token
    (``AROUND`` tokens to each side), and the longest stretch with at least
    ``same`` equal tokens must span ``least`` tokens or the whole item, if that
    is shorter.  With ``least`` and ``same`` as they are, or greater, every such
    stretch holds a mask that fits, so none is missed.  Items shorter than
    ``shortest`` tokens have no seed and never match; from 1 on all match.

    The filter only holds back hashes that no item has; the join on the hash
    and the comparison decide.  A null or empty text on either side overlaps
    with nothing.  Equal texts are compared once, and equal rows give one result, as do
    rows without an id (for each item, the longest overlap); other columns are ignored.  An item that is frequent in the
    documents is joined on (hash, text) rows and so spreads with them; a pattern that repeats in a text is one row.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    item_tokens = items.mapInPandas(_item_tokens, "item_id long, item_tokens binary")
    item_seeds = items.mapInPandas(_item_seeds(shortest), "item_id long, hash long, item_at int, item_step int, item_times int")
    lengths = item_tokens.select(F.least(F.lit(SPAN), F.octet_length("item_tokens") / 8).cast("int").alias("n")).distinct().collect()  # at most SPAN + 1
    masks = masks_for([r["n"] for r in lengths if r["n"] >= max(1, shortest)])
    bit = F.shiftrightunsigned("hash", 64 - BITS)
    blocks = (
        item_seeds.select(bit.alias("bit")).distinct()
        .groupBy(F.bitmap_bucket_number("bit").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    )
    size = 1 << 15  # bits of a block
    bitmap = np.zeros((1 << BITS) // 8 + size, np.uint8)
    for row in blocks:  # blocks count from 1 and start with bit 1; bit 0 is in block 0
        at = (row["block"] - 1) * size // 8 if row["block"] else len(bitmap) - size // 8
        own = np.frombuffer(bytes(row["bits"]), np.uint8)
        bitmap[at : at + len(own)] |= own
    shared = spark.sparkContext.broadcast(bitmap)  # 2 MB

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        for batch in batches:
            rows = []
            for key, text in zip(batch["text_key"], batch["text"], strict=True):
                tokens = tokens_of(text)
                hashes, places = seeds(tokens, masks)
                slots = (hashes >> np.uint64(64 - BITS)).astype(np.int64) - 1  # as block and position, from bit 1
                slots[slots < 0] = len(bits) * 8 - size
                maybe = np.flatnonzero(bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1)
                if not len(maybe):
                    continue
                maybe = maybe[np.argsort(places[maybe], kind="stable")]
                at = places[maybe]
                groups = np.split(maybe, np.flatnonzero(np.diff(at) > AROUND) + 1)
                for number, group in enumerate(groups):
                    own = places[group]
                    start = max(0, int(own[0]) - AROUND)
                    kept = tokens[start : int(own[-1]) + SPAN + AROUND]
                    entries = strides(hashes[group], own)
                    hits = [dict(zip(("hash", "at", "step", "times"), e, strict=True)) for e in zip(*(x.astype(np.int64).tolist() for x in entries), strict=True)]
                    rows.append((key, number, start, kept.tobytes(), hits))
            yield pd.DataFrame(rows, columns=["text_key", "cluster", "start", "tokens", "hits"])
        release()

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").where("text IS NOT NULL")
    found = staged(keyed.select("text_key", "text").mapInPandas(search, HIT), "benchmark-hits").dropDuplicates(["text_key", "cluster"])
    diagonals = (
        found.select("text_key", "cluster", F.explode("hits").alias("hit")).select("text_key", "cluster", "hit.*")
        .join(item_seeds, "hash").select("text_key", "cluster", "item_id", F.explode(F.expr(SHIFTS)).alias("shift")).distinct()
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                left, right = np.frombuffer(row.tokens, np.uint64), np.frombuffer(row.item_tokens, np.uint64)
                offset = row.shift - row.start  # of the item's first token in the kept tokens
                low, high = max(0, -offset), min(len(right), len(left) - offset)
                equal = left[low + offset : high + offset] == right[low:high]
                at, length = longest_overlap(equal, same)
                if length >= min(least, len(right)):
                    rows.append((row.text_key, row.item_id, row.start + low + offset + at, low + at, length, int(equal[at : at + length].sum())))
            yield pd.DataFrame(rows, columns=["text_key", "item_id", "doc_start", "item_start", "n_tokens", "n_equal"])

    sides = (
        diagonals.join(found.drop("hits"), ["text_key", "cluster"]).join(item_tokens, "item_id")
        .select("text_key", "item_id", "shift", "start", "tokens", "item_tokens")
    )
    overlaps = sides.mapInPandas(compare, "text_key long, item_id long, doc_start int, item_start int, n_tokens int, n_equal int")
    best = F.max_by(F.struct("doc_start", "item_start", "n_tokens", "n_equal"), F.struct("n_equal", "n_tokens", -F.col("doc_start"), -F.col("item_start")))
    overlaps = staged(overlaps.groupBy("text_key", "item_id").agg(best.alias("best")).select("text_key", "item_id", "best.*"), "overlaps")
    # texts are read again for their ids only
    ids = keyed.select("doc_id", "text_key")
    named = ids.join(F.broadcast(overlaps) if overlaps.count() <= SENT else overlaps, "text_key")
    return named.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def without_overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, same: float = SAME, shortest: int = 1) -> DataFrame:
    """The documents that overlap with no benchmark item, however short.

    Decided by text: rows with a null id are searched like others, and of rows that share an
    id only those go whose own text overlaps.  Rows with a null text stay.
    """
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    leaks = staged(contaminated(texts, benchmark, least, same, shortest).select(F.col("doc_id").alias("__leak")).distinct(), "leaks")
    return docs.join(F.broadcast(leaks) if leaks.count() <= SENT else leaks, F.xxhash64(docs["text"]) == F.col("__leak"), "left_anti")


@query()
def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, and which."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
