"""Weighted resampling and proportional mixing of sources."""

from __future__ import annotations

from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as V
from ..functions.keys import hash_key, hash_number
from .attach import attach, refuse_columns
from .order import attach_cut_keys, hash_order


COPIES_AT_ONCE = 1000


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """The weights, as they are written, times the smallest number that makes all of them whole."""
    exact = {key: Fraction(str(weight)) for key, weight in weights.items()}
    scale = lcm(*[weight.denominator for weight in exact.values()])
    return {key: int(weight * scale) for key, weight in exact.items()}


def weight_of(key: str, weights: dict[str, float]) -> Column:
    """Integer weight of a value, from a constant map, in exact proportion; null for values not in it."""
    entries = [F.lit(x) for k, w in whole_weights(weights).items() for x in (k, w)]
    return F.try_element_at(F.create_map(*entries), F.col(key)).cast("bigint")


PIECE_ROWS = 500_000


def with_probability(df: DataFrame, weight: str, name: str = "probability") -> DataFrame:
    """Each row's share of all weight."""
    return df.withColumn(name, F.col(weight) / df.agg(F.sum(weight).alias("total")).scalar())


def weighted_resample(
    df: DataFrame, id_column: str, weight: str, seed: int | str = V.SEED, digits: int | None = None,
    copy_name: str = "copy",
) -> DataFrame:
    """As many draws as rows, with replacement, proportional to an integer weight.

    The rows lie end to end on a line, each as long as its weight, in hash
    order; every row also throws one hash-uniform point on that line.  The line is
    cut both at the hash buckets and at equal distances, so a piece holds neither
    too many rows nor too many points, however uneven the weights are.  Inside a
    piece the points are matched with one sorted pass.  Draws are counted per row
    before they meet the wide rows again, so a heavy row is not a hot key.

    Rows with a null or non-positive weight take no part.  ``copy`` numbers the
    draws of one row from 1.  The line is cut into 16**digits pieces; by default into so many
    that a piece has about ``PIECE_ROWS`` rows and points, as counted.
    """
    refuse_columns(df, copy_name, "__hit", "__draws")
    usable = df.where(F.col(weight) > 0)
    if digits is None:
        digits, rows = 2, usable.count()
        while rows > PIECE_ROWS * 16**digits:
            digits += 1
    key = hash_key(seed, id_column)
    narrow = usable.select(
        F.col(id_column).alias("__id"), F.col(weight).cast("bigint").alias("__w"), key.alias("__key")
    ).withColumn("__bucket", F.substring("__key", 1, digits))

    pieces = 16**digits
    sums = narrow.groupBy("__bucket").agg(F.sum("__w").alias("__sum"))
    along = Window.partitionBy().orderBy("__bucket")
    line = sums.select(
        "__bucket",
        (F.sum("__sum").over(along) - F.col("__sum")).alias("__from"),
        F.sum("__sum").over(along).alias("__to"),
        F.sum("__sum").over(Window.partitionBy()).alias("__line"),
    ).withColumn("__step", F.ceil(F.col("__line") / pieces))

    # rows as intervals, one entry per piece of the line they touch
    inside = Window.partitionBy("__bucket").orderBy("__key").rowsBetween(Window.unboundedPreceding, 0)
    placed = attach(narrow, line.select("__bucket", "__from", "__step"), ["__bucket"])
    ends = placed.withColumn("__hi", F.col("__from") + F.sum("__w").over(inside))
    intervals = ends.withColumn("__lo", F.col("__hi") - F.col("__w")).select(
        "__bucket",
        F.explode(F.expr("sequence(__lo div __step, (__hi - 1) div __step)")).alias("__piece"),
        F.col("__lo").alias("__pos"),
        F.lit(0).alias("__kind"),
        "__id",
    )

    # one point per row, sent to the bucket that holds its position
    touched = line.select(
        "__bucket", "__from", "__to",
        F.explode(F.expr("sequence(__from div __step, (__to - 1) div __step)")).alias("__piece"),
    )
    scale = line.agg(F.max("__line").alias("__line"), F.max("__step").alias("__step"))
    thrown = narrow.withColumns(
        {
            "__line": scale.select("__line").scalar(),
            "__step": scale.select("__step").scalar(),
        }
    ).select(
        (hash_number(hash_key(f"{seed}-draw", "__id")) % F.col("__line")).alias("__pos"), "__step"
    ).withColumn("__piece", F.expr("__pos div __step"))
    points = (
        attach(thrown, touched, ["__piece"], how="inner")
        .where("__pos >= __from and __pos < __to")
        .select("__bucket", "__piece", "__pos", F.lit(1).alias("__kind"), F.lit(None).cast(narrow.schema["__id"].dataType).alias("__id"))
    )

    sweep = (
        Window.partitionBy("__bucket", "__piece").orderBy("__pos", "__kind")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    drawn = (
        intervals.unionByName(points)
        .withColumn("__hit", F.last("__id", ignorenulls=True).over(sweep))
        .where("__kind = 1")
        .groupBy("__hit").agg(F.count("*").alias("__draws"))
    )
    met = usable.join(drawn, F.col(id_column) == F.col("__hit"))
    return copied(met, F.col("__draws"), id_column, copy_name).drop("__hit", "__draws")


def copied(df: DataFrame, copies: Column, id_column: str, copy_name: str) -> DataFrame:
    """Every row ``copies`` times, numbered from 1.

    A row first becomes one row per COPIES_AT_ONCE copies; those are dealt out by
    (id, part), so the copies of one row are made by many tasks.
    """
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__copies") - 1) / COPIES_AT_ONCE)))
    dealt = (
        df.withColumn("__copies", copies).where("__copies > 0").withColumn("__part", parts)
        .repartition(F.col(id_column), "__part")
    )
    first = F.col("__part") * COPIES_AT_ONCE
    numbers = F.sequence(first + 1, F.least(F.col("__copies"), first + COPIES_AT_ONCE))
    return dealt.withColumn(copy_name, F.explode(numbers)).drop("__copies", "__part")


def mix_sources(
    df: DataFrame, id_column: str, shares: dict[str, float], source: str = "dataset",
    seed: int | str = V.SEED, copy_name: str = "copy",
) -> DataFrame:
    """Oversample sources to fixed shares until every source is used up at least once.

    The mix has N rows, N being the smallest size at which the largest source (by
    size over share) fits in whole.  Source i gives round(N * share): every row
    quota div size times, plus once more for the remainder, chosen by hash.  Rows
    of sources without a share are left out.
    """
    refuse_columns(df, copy_name, "__size", "__quota", "__cut")
    named = df.where(F.col(source).isin(list(shares)))
    sizes = named.groupBy(source).agg(F.count("*").alias("__size"))
    share = F.element_at(
        F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col(source)
    )
    rows = sizes.agg(F.max(F.ceil(F.col("__size") / share)).alias("__rows")).scalar()
    quota = F.floor(rows * share + F.lit(0.5)).cast("bigint")

    order = hash_order(id_column, seed)
    counted = attach(named, sizes.withColumn("__quota", quota), [source])
    marked = attach_cut_keys(counted, order, {"__cut": lambda size: quota % size}, group=[source])
    once_more = F.when(order.key <= F.col("__cut"), 1).otherwise(0)
    copies = F.expr("__quota div __size") + once_more
    return copied(marked, copies, id_column, copy_name).drop("__size", "__quota", "__cut")


def mix_order(id_column: str, source: str = "dataset", copy_name: str = "copy", seed: int | str = V.SEED) -> Column:
    """Sort key that interleaves the mixed sources."""
    return hash_key(f"{seed}-mix", source, id_column, copy_name)
