"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only."""

from __future__ import annotations

import heapq
import json
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import query, table

BLOCK = 16  # rows that stay together
SOURCES = 10_000  # most sources; one count of each comes to the driver
ROWS_PER_BUCKET = 4_000  # rows that one task sorts when rows of a source are numbered
RESULT = ("block", "phase", "slot", "position")


def cycle(parts: dict[str, int]) -> list[str]:
    """One cycle of ``sum(parts)`` slots, by earliest deadline first.

    Block k (from 0) of a source with n of M parts is released in slot
    floor(k*M/n) and due before slot ceil((k+1)*M/n).  Total weight is one, so
    every slot is used and every block meets its window; a source is then less
    than one block away from its share after every slot.  Ties: by name.
    """
    total = sum(parts.values())
    released: list[tuple[int, str, int]] = []
    coming = [(0, name, 0) for name in sorted(parts)]
    heapq.heapify(coming)
    order = []
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            _, name, k = heapq.heappop(coming)
            heapq.heappush(released, (-(-(k + 1) * total // parts[name]), name, k))
        _, name, k = heapq.heappop(released)
        order.append(name)
        if k + 1 < parts[name]:
            heapq.heappush(coming, ((k + 1) * total // parts[name], name, k + 1))
    return order


def plan(counts: dict[str, int], parts: dict[str, int], block: int) -> tuple[dict[str, list[dict]], list[dict]]:
    """The phases of every source, and where blocks are short.

    A phase ends with the last block of a source; the others then share by
    their weights among themselves, with a new cycle.  Only counts are used,
    so the plan is as small as the weights: sources times parts.
    """
    left = {name: -(-count // block) for name, count in counts.items() if count}
    taken = dict.fromkeys(left, 0)
    phases: dict[str, list[dict]] = {name: [] for name in left}
    short, start, number = [], 0, 0
    while left:
        order = cycle({name: parts[name] for name in left})
        size = len(order)
        slots: dict[str, list[int]] = {name: [] for name in left}
        for slot, name in enumerate(order):
            slots[name].append(slot)
        length = min(
            (blocks - 1) // len(slots[name]) * size + slots[name][(blocks - 1) % len(slots[name])] + 1
            for name, blocks in left.items())
        for name in list(left):
            own = slots[name]
            used = length // size * len(own) + sum(s < length % size for s in own)
            if used:
                phases[name].append({"phase": number, "first": taken[name], "last": taken[name] + used,
                                     "start": start, "size": size, "slots": own})
            taken[name] += used
            left[name] -= used
            if not left[name]:
                del left[name]
                if counts[name] % block:
                    short.append({"slot": start + length - 1, "gap": block - counts[name] % block})
        start += length
        number += 1
    return phases, short


def _name(source: Column) -> Column:
    """A key that tells a null source from all named ones."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def numbered(docs: DataFrame, name: Column, id_column: str, seed: int) -> DataFrame:
    """Add ``__name`` and ``__row``, the place (from 0) of the row in the shuffled order of its source.

    The order is that of a seeded hash of the id.  A source is cut into buckets
    along the hash, as many as its rows need, so the largest source is sorted by
    many tasks; rows move once.
    """
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column).cast("string")), 1)  # 63 bits
    keyed = docs.withColumns({"__name": name, "__key": key})
    fine = F.shiftright("__key", 43)  # 20 bits
    total = docs.select(F.count("*").alias("n")).scalar()
    buckets = F.least(F.lit(1 << 20), F.greatest(F.lit(1), (total / ROWS_PER_BUCKET).cast("int")))
    bucket = F.shiftright(fine * buckets, 20)
    cells = keyed.groupBy("__name", bucket.alias("__bucket")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("__name").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("__name", "__bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__name", "__bucket").orderBy("__key", F.col(id_column))
    return (
        keyed.withColumn("__bucket", bucket).join(before, ["__name", "__bucket"])
        .withColumn("__row", F.col("__before") + F.row_number().over(inside) - 1)
        .drop("__key", "__bucket", "__before")
    )


def mix(
    docs: DataFrame, weights: dict[str | None, int] | None = None, block: int = BLOCK, source: str = "source",
    id_column: str = "doc_id", seed: int = 42, parts: int = 1000,
) -> DataFrame:
    """Put all rows in an order in which every source keeps its target weight.

    ``weights`` are whole parts per source (sources without one get 1; at least
    1).  Without weights a source gets ``parts`` in proportion to the square
    root of its row count, at least 1.  Every source is shuffled by a hash of
    the id and cut into blocks of ``block`` rows; Pfair scheduling gives every
    block its slot (see ``cycle``), and within a phase, as long as no source runs
    out, every source is less than one block away from its weight.  No row is
    dropped or repeated: a source that runs out leaves its share to the rest.

    Adds ``block`` (of its source, from 0), ``phase``, ``slot`` and ``position``
    (of the row, dense from 0), in place of columns of these names.  A null source is a source; null ids, equal ids and
    repeated rows are rows like all others; an empty table stays empty.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in RESULT])
    aside = {c: f"{c}__own" for c in docs.columns if c.lower() in ("__name", "__row", "__key", "__bucket", "__before", "__plan", "__at")}
    docs = docs.withColumnsRenamed(aside)
    found = docs.groupBy(F.col(source).alias("source"), _name(F.col(source)).alias("name")).count().limit(SOURCES + 1).collect()
    if len(found) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    counts = {r["name"]: r["count"] for r in found}
    if weights is None:
        roots = {name: isqrt(count) for name, count in counts.items()}
        share = {name: max(1, parts * root // sum(roots.values())) for name, root in roots.items()}
    else:
        share = {r["name"]: max(1, int(weights.get(r["source"], 1))) for r in found}
    phases, short = plan(counts, share, block)
    spark = docs.sparkSession
    shape = "array<struct<name string, phases array<struct<phase int, first bigint, last bigint, start bigint, size int, slots array<int>>>>>"
    text = json.dumps([{"name": name, "phases": own} for name, own in sorted(phases.items())])
    plans = spark.range(1).select(F.inline(F.from_json(F.lit(text), shape))).select(
        F.col("name").alias("__name"), F.col("phases").alias("__plan"))
    gaps = F.from_json(F.lit(json.dumps(short)), "array<struct<slot bigint, gap int>>")
    row = F.col("__row")
    number = F.floor(row / block).cast("long")
    place = F.col("block") - F.col("__at.first")
    own = F.col("__at.slots")
    each = F.size(own)
    return (
        numbered(docs, _name(F.col(source)), id_column, seed)
        .join(F.broadcast(plans), "__name")  # one row per source, at most SOURCES
        .withColumn("block", number)
        .withColumn("__at", F.get(F.filter("__plan", lambda p: (p["first"] <= F.col("block")) & (F.col("block") < p["last"])), F.lit(0)))
        .withColumn("phase", F.col("__at.phase"))
        .withColumn("slot", F.col("__at.start") + F.floor(place / each) * F.col("__at.size") + F.get(own, (place % each).cast("int")))
        .withColumn("position", F.col("slot") * block + row % block - F.aggregate(
            F.filter(gaps, lambda g: g["slot"] < F.col("slot")), F.lit(0).cast("long"), lambda total, g: total + g["gap"]))
        .drop("__name", "__row", "__plan", "__at").withColumnsRenamed({new: old for old, new in aside.items()})
    )


@query()
def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in mixed order, sources weighted by the square root of their size."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
