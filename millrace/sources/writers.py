"""Writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed_values as V
from ..functions.text import soften_quotes
from ..operators.attach import refuse_columns
from ..operators.joins import drop_rows
from ..operators.order import RowOrder, number_order
from ..session import work_path


def write_shards(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("split",), max_records: int = 0,
    mode: str = "overwrite",
) -> None:
    """Parquet shards per partition value.

    Rows are rebalanced to the session's advisory partition size first, which
    also splits a partition value that holds most of the rows over several tasks.
    """
    balanced = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = balanced.write.mode(mode).option("maxRecordsPerFile", max_records)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def sized_shards(df: DataFrame, order: RowOrder, width: Column, shard_bytes: int, name: str = "shard") -> DataFrame:
    """Add the shard of each row: rows in order, packed so that each shard begins where the widths before it pass a multiple of ``shard_bytes``.

    A running sum of widths, bucket by bucket.  Every shard but the last has
    ``shard_bytes`` up to the width of a row; a row wider than that may leave numbers out.
    """
    refuse_columns(df, name, "__bucket", "__key", "__width", "__ahead", "__b")
    rows = df.withColumns({"__bucket": order.bucket, "__key": order.key, "__width": F.coalesce(width.cast("bigint"), F.lit(0).cast("bigint"))})
    sums = rows.groupBy("__bucket").agg(F.sum("__width").alias("__sum"))
    ahead = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    sums = sums.select(F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy("__bucket").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(sums, F.col("__bucket").eqNullSafe(F.col("__b"))).withColumn("__before", F.col("__ahead") + F.coalesce(F.sum("__width").over(inside), F.lit(0)))
    return placed.withColumn(name, F.expr(f"__before div {int(shard_bytes)}")).drop("__bucket", "__key", "__width", "__ahead", "__b", "__before")


def write_sized_shards(
    df: DataFrame, path: str, row_id: str, width: Column, file_bytes: int = V.SHARD_BYTES, mode: str = "overwrite",
) -> None:
    """One Parquet file of about ``file_bytes`` per shard, in folders ``shard=n``, rows in the order of ``row_id`` (a whole number).

    ``width`` measures a row.  How many bytes of a file come to one of width is measured on
    the table itself, written to the work folder once, so files keep their size whatever the encoding saves.
    """
    spark = df.sparkSession
    trial = work_path(spark, "shards")
    df.write.parquet(trial)
    rows = spark.read.schema(df.schema).parquet(trial)
    stored = rows.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n")).distinct().agg(F.sum("n")).first()[0] or 0
    wide = rows.agg(F.sum(width)).first()[0] or 0
    scaled = max(1, int(file_bytes * wide / stored)) if stored else file_bytes
    shards = sized_shards(rows, number_order(rows, row_id), width, scaled)
    shards.repartition("shard").sortWithinPartitions("shard", row_id).write.mode(mode).partitionBy("shard").parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet as the plan leaves it, without another shuffle."""
    df.write.mode(mode).parquet(path)


def write_quoted_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """CSV with header, every field quoted, double quotes softened beforehand."""
    df.select(*[soften_quotes(c).alias(c) for c in columns]).write.mode(mode).csv(
        path, header=True, quoteAll=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, nulls kept out."""
    df.write.mode(mode).json(path)


def append_new_rows(df: DataFrame, path: str, row_id: str) -> None:
    """Append the rows whose id the table does not hold yet.

    Can be repeated after an interruption: rows already written are skipped.
    """
    spark = df.sparkSession
    try:
        written = spark.read.parquet(path).select(row_id)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        written = None
    fresh = df if written is None else drop_rows(df, written, row_id)
    fresh.write.mode("append").parquet(path)


def write_json_batch(df: DataFrame, folder: str, split: str, number: int) -> None:
    """One batch as ``{split}_batch_{number}.json``, a folder of JSON rows (``readers.read_json_batches``); repeating it replaces it."""
    df.write.mode("overwrite").json(f"{folder}/{split}_batch_{number}.json")
