"""Row order at scale: shuffles, dense ranks, batches and exact-size cut-offs.

Nothing here sorts all rows in one task.  Keys are spread over buckets that
follow the order; the rows per bucket are counted; the running sum of those
counts (a small table) gives every bucket its offset.  A rank is then the offset
plus the position inside the bucket, and "the first n rows" is a comparison with
one key, found inside the single bucket where the count passes n.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import fixed_values as V
from ..functions.keys import hash_key
from .attach import attach, refuse_columns

KEY, BUCKET, GROUP = "__key", "__bucket", "__group"
BUCKET_ROWS = 1_000_000  # rows of a bucket; callers with wide rows state less (``rows_for``)
BUCKET_BYTES = 1 << 28


def rows_for(df: DataFrame, width: Column, bytes_: int = BUCKET_BYTES) -> int:
    """How many rows of the measured average width make a bucket of so many bytes."""
    mean = df.agg(F.avg(width).alias("mean")).first()["mean"]
    return max(1, int(bytes_ / max(1.0, mean or 1.0)))


@dataclass(frozen=True)
class RowOrder:
    """A total order (``key``, unique per row) and buckets that follow it."""

    key: Column
    bucket: Column


def hash_order(
    id_column: str, seed: int | str = V.SEED, digits: int = 3, rows: int | None = None, most: int = BUCKET_ROWS,
) -> RowOrder:
    """Seeded shuffle order; 16**digits evenly filled buckets per group.

    With the number of ``rows``, so many more digits that a bucket, which is what
    one task sorts, holds about ``most`` rows or fewer.
    """
    key = hash_key(seed, id_column)
    while rows is not None and rows > most * 16**digits:
        digits += 1
    return RowOrder(key, F.substring(key, 1, digits))


def sortable_hex(value: Column) -> Column:
    """16 hex digits that order as the whole number does."""
    return F.lpad(F.hex(value.cast("bigint").bitwiseXOR(F.lit(-(2**63)))), 16, "0")


def fitted_buckets(df: DataFrame, digits: Column, most: int = BUCKET_ROWS, step: int = 1) -> Column:
    """Prefixes of a hex key as buckets that follow its order and hold at most ``most`` rows each, as counted.

    A bucket that holds more is cut again, by ``step`` more digits, until none does
    or the key has no more digits; other buckets stay as they are.  Each round reads the key of the rows
    in overfull buckets only and brings back those buckets, at most one for every ``most`` rows.
    """
    ends = df.agg(F.min(digits).alias("low"), F.max(digits).alias("high"), F.max(F.length(digits)).alias("size")).first()
    if ends["low"] is None:
        return F.substring(digits, 1, 1)
    width = 0
    while width < ends["size"] and ends["low"][width : width + 1] == ends["high"][width : width + 1]:
        width += 1  # what all keys begin with
    width = min(ends["size"], width + step)
    bucket, open_rows = F.substring(digits, 1, width), df.select(digits.alias("__digits"))
    while width < ends["size"]:
        counts = open_rows.groupBy(F.substring("__digits", 1, width).alias("prefix")).count()
        full = [r["prefix"] for r in counts.where(F.col("count") > most).collect()]
        if not full:
            break
        open_rows = open_rows.where(F.substring("__digits", 1, width).isin(full))
        wider = min(ends["size"], width + step)
        bucket = F.when(F.substring(digits, 1, width).isin(full), F.substring(digits, 1, wider)).otherwise(bucket)
        width = wider
    return bucket


def number_order(df: DataFrame, id_column: str, parts: int = 256, most: int = BUCKET_ROWS) -> RowOrder:
    """Ascending order of a numeric id.

    Whole numbers: buckets of at most ``most`` rows with different ids, from counts (``fitted_buckets``),
    however the ids lie; small tables still have some.  Other numbers: ``parts`` buckets between approximate
    quantiles.  Borders only decide which task sorts a row, never its rank.
    """
    value = F.col(id_column)
    if isinstance(df.schema[id_column].dataType, T.IntegralType):
        return RowOrder(value, fitted_buckets(df, sortable_hex(value), most))
    steps = [i / parts for i in range(1, parts)]
    # a subquery cannot be the argument of a higher-order function, so the borders are fetched: one small job
    borders = df.agg(F.percentile_approx(id_column, steps, 10 * parts).alias("b")).first()["b"]
    borders = sorted(set(borders or []))
    if not borders:
        return RowOrder(value, F.lit(0))
    width = max(1, int(len(borders) ** 0.5))
    slices = [borders[i : i + width] for i in range(0, len(borders), width)]
    coarse = F.size(F.filter(F.lit([s[-1] for s in slices]), lambda b: b < value))
    inside = F.element_at(F.array(*[F.lit(s) for s in slices]), F.least(coarse + 1, F.lit(len(slices))))
    return RowOrder(value, coarse * (width + 1) + F.size(F.filter(inside, lambda b: b < value)))


def _keyed(df: DataFrame, order: RowOrder, group: Sequence[str]) -> tuple[DataFrame, list[str]]:
    keyed = df.withColumns({KEY: order.key, BUCKET: order.bucket})
    if group:
        return keyed, list(group)
    return keyed.withColumn(GROUP, F.lit(0)), [GROUP]


def with_rank(
    df: DataFrame, order: RowOrder, group: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Dense 1-based rank per group, in one shuffle of the rows.  ``name`` must be a new column."""
    refuse_columns(df, name, KEY, BUCKET, GROUP, "__before")
    keyed, by = _keyed(df, order, group)
    counts = keyed.groupBy(*by, BUCKET).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by, BUCKET, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy(*by, BUCKET).orderBy(KEY)
    return (
        attach(keyed, offsets, [*by, BUCKET])
        .withColumn(name, F.col("__before") + F.row_number().over(inside))
        .drop(KEY, BUCKET, GROUP, "__before")
    )


def cut_keys(
    df: DataFrame,
    order: RowOrder,
    marks: dict[str, Callable[[Column], Column]],
    group: Sequence[str] = (),
) -> DataFrame:
    """Per group and mark, the key of the row at that 1-based position.

    ``marks`` maps a column name to a function of the group's row count.  A
    position of 0 gives a null key; one past the end gives the last key.  Only
    the order key is read, and only the buckets holding a mark are sorted.
    """
    keyed, by = _keyed(df, order, group)
    keyed = keyed.select(*by, KEY, BUCKET)
    counts = keyed.groupBy(*by, BUCKET).agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(*by)
    totals = counts.select(
        *by, BUCKET, "__n",
        F.sum("__n").over(whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, 0)).alias("__upto"),
        F.sum("__n").over(whole).alias("__total"),
    )
    wanted = F.explode(
        F.array(*[
            F.struct(
                F.lit(mark).alias("mark"),
                F.least(at(F.col("__total")).cast("bigint"), F.col("__total")).alias("at"),
            )
            for mark, at in marks.items()
        ])
    )
    hits = (
        totals.withColumn("__m", wanted)
        .where("__m.at > __upto - __n and __m.at <= __upto")
        .select(*by, BUCKET, F.col("__m.mark").alias("__mark"), F.expr("__m.at - (__upto - __n)").alias("__nth"))
    )
    inside = Window.partitionBy(*by, BUCKET, "__mark").orderBy(KEY)
    return (
        attach(keyed, hits, [*by, BUCKET], how="inner")
        .withColumn("__pos", F.row_number().over(inside))
        .where("__pos = __nth")
        .groupBy(*by)
        .agg(*[F.max(F.when(F.col("__mark") == m, F.col(KEY))).alias(m) for m in marks])
    )


def attach_cut_keys(
    df: DataFrame, order: RowOrder, marks: dict[str, Callable[[Column], Column]],
    group: Sequence[str] = (), within: DataFrame | None = None,
) -> DataFrame:
    """Add the cut keys of each row's group as columns (null where there is none).

    ``within`` restricts which rows are counted; all rows of ``df`` are returned.
    """
    cuts = cut_keys(df if within is None else within, order, marks, group)
    if group:
        return attach(df, cuts, group)
    keys = cuts.select(F.struct(*marks)).scalar()
    return df.withColumns({mark: keys[mark] for mark in marks})


def seeded_shuffle(df: DataFrame, id_column: str, seed: int | str = V.SEED) -> DataFrame:
    """All rows in seeded random order (a range-partitioned sort)."""
    key = hash_key(seed, id_column)
    return df.orderBy(key, F.col(id_column))


def sample_rows(
    df: DataFrame, id_column: str, rows: int, seed: int | str = V.SEED, group: Sequence[str] = (),
    digits: int = 3,
) -> DataFrame:
    """``min(rows, size)`` rows (per group) without replacement.

    A filter against one key per group, so the size of the sample does not matter.
    """
    order = hash_order(id_column, seed, digits)
    marked = attach_cut_keys(df, order, {"__cut": lambda total: F.lit(rows)}, group)
    return marked.where(order.key <= F.col("__cut")).drop("__cut")


def row_batches(
    df: DataFrame, order: RowOrder, size: int = V.WRITE_BATCH, group: Sequence[str] = (),
    name: str = "batch_id",
) -> DataFrame:
    """Consecutive batches of ``size`` rows in the given order, numbered from 0."""
    ranked = with_rank(df, order, group, "__rank")
    return ranked.withColumn(name, F.floor((F.col("__rank") - 1) / size).cast("bigint")).drop("__rank")


def row_index(
    df: DataFrame, order: RowOrder, group: Sequence[str] = (), name: str = "row_index"
) -> DataFrame:
    """Dense 0-based position per group."""
    return with_rank(df, order, group, name).withColumn(name, F.col(name) - 1)


def head_rows(df: DataFrame, id_column: str, rows: int = 1, last: bool = False) -> DataFrame:
    """The first (or last) few rows by id, for looking at."""
    key = F.col(id_column)
    return df.orderBy(key.desc() if last else key.asc()).limit(rows)


def top_k(
    df: DataFrame, by: Sequence[str], score: str, id_column: str, k: int = 1, largest: bool = True
) -> DataFrame:
    """The ``k`` best rows per group, ties to the smaller id, with their ``rank``.

    Spark keeps only ``k`` rows per group and task before the shuffle.
    """
    key = F.col(score).desc() if largest else F.col(score).asc()
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(key, id_column)))
    return ranked.where(F.col("rank") <= k)
