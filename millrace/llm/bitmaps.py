"""Filters of a bounded size: bits that tasks look up before rows move."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 20, 27  # 128 KB to 16 MB, whatever is marked


def slots_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def bits_for(rows: int) -> int:
    """Some 16 bits per row, as far as the size allows."""
    return min(MOST_BITS, max(LEAST_BITS, (16 * rows).bit_length()))


def collected(slots: DataFrame, bits: int) -> np.ndarray:
    """The bitmap in which the slots of the one column ``slot`` are set: 2**bits bits, put together by Spark."""
    marked = slots.select((F.col("slot") + 1).alias("slot"))  # buckets count from 1
    blocks = marked.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for row in blocks.toLocalIterator():
        own = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = (row["block"] - 1) * len(own)
        bitmap[at : at + len(own)] = own[: len(bitmap) - at]
    return bitmap


def holds(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)
