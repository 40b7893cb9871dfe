"""Cleaning and deduplicating files as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def new_files(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def append_stream(
    stream: DataFrame, chain: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str
) -> StreamingQuery:
    """Run a row-wise chain on everything available and append it to a Parquet table.

    The sink's log and the checkpoint together write every input row exactly once,
    also when the query is stopped and started again.
    """
    return (
        chain(stream)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def first_seen(
    stream: DataFrame, key: Column, name: str = "content_key", time: str | None = None,
    lateness: str | None = None,
) -> DataFrame:
    """One row per key over the life of the stream.

    Without a time column the state holds every key ever seen.  With one, keys
    are forgotten once ``lateness`` has passed, which bounds the state; rows that
    come later than that are dropped, so it has to be given (``ValueError``).
    """
    if time is not None and lateness is None:
        raise ValueError("state the lateness: later rows are dropped")
    keyed = stream.withColumn(name, key)
    if time is None:
        return keyed.dropDuplicates([name])
    return keyed.withWatermark(time, lateness).dropDuplicatesWithinWatermark([name])


class BatchTable:
    """A table that a stream appends to batch by batch, each exactly once.

    Rows of a batch go to a folder of its number; then an entry of the ledger says that
    the batch is complete.  A batch that is in the ledger is not computed again, one
    that stopped halfway is written anew, and readers see the batches of the ledger only.  So a batch that
    the stream repeats, after a stop at any point, changes nothing, whatever the chain does with it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> list[int]:
        """The numbers of the complete batches."""
        try:
            found = self.spark.read.option("basePath", f"{self.path}/ledger").schema("rows long, batch long").parquet(f"{self.path}/ledger")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r["batch"] for r in found.select("batch").distinct().collect())  # one per batch

    def write(self, batch: DataFrame, number: int, before_commit: Callable[[int], None] | None = None) -> None:
        """Write a batch, unless the ledger has it.  ``before_commit`` runs between the rows and the ledger's entry."""
        if number in self.batches():
            return
        folder = f"{self.path}/rows/batch={number}"
        batch.write.mode("overwrite").parquet(folder)
        rows = self.spark.read.schema(batch.schema).parquet(folder).agg(F.count("*").alias("rows"))
        if before_commit:
            before_commit(number)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/batch={number}")

    def read(self, schema: StructType) -> DataFrame:
        """All rows of complete batches."""
        folders = [f"{self.path}/rows/batch={n}" for n in self.batches()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)


def append_batches(
    stream: DataFrame, chain: Callable[[DataFrame], DataFrame], table: BatchTable, checkpoint: str,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Run any chain (joins with tables and aggregates of the batch too) on each batch of what is available and append it to ``table``."""
    return (
        stream.writeStream.foreachBatch(lambda batch, number: table.write(chain(batch), number, before_commit))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


PAUSE_BUCKETS = 256  # groups of keys that ``seen_after_pause`` keeps its state in


def seen_after_pause(
    stream: DataFrame, key: Column, time: str, row_id: str, pause_seconds: int, lateness: str, name: str = "content_key",
    buckets: int = PAUSE_BUCKETS,
) -> DataFrame:
    """Rows whose key was not seen for more than ``pause_seconds`` before them (or never): ``content_key``, id and time.

    Keys are dealt to ``buckets`` by hash; the state of a bucket holds the time each of its keys was last seen, so a
    batch costs one call per bucket and not one per key.  A timer drops the keys
    whose last time the watermark has passed by the pause: a key that stops coming takes no
    more memory, and one that comes back later counts as new, which is the same.
    Rows are taken in the order of their times, then ids, within a batch.  A row
    later than ``lateness`` behind the newest one of earlier batches is dropped by the watermark, which starts at 1970.
    Rows without a time or a key are left out.  ``buckets`` belongs to the checkpoint and cannot change with it.
    """
    keyed = stream.select(key.alias(name), F.col(row_id), F.col(time).cast("timestamp").alias("ts")).where(F.col(name).isNotNull() & F.col("ts").isNotNull())
    keyed = keyed.withColumns({"__at": F.unix_micros("ts"), "__bucket": F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")})
    schema = T.StructType([T.StructField(name, T.StringType()), stream.schema[row_id], T.StructField("ts", T.TimestampType())])
    pause = pause_seconds * 1_000_000

    def keep(state: GroupState, seen: pd.Series) -> None:
        """Store the keys that a row may still meet, with a timer for the one that goes first."""
        mark = state.getCurrentWatermarkMs()
        until = (seen + pause) // 1000 + 1
        seen, until = seen[until > mark], until[until > mark]
        if len(seen):
            state.update((seen.index.tolist(), seen.tolist()))
            state.setTimeoutTimestamp(int(until.min()))
        elif state.exists:
            state.remove()

    def step(_own: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, last = state.get if state.exists else ([], [])
        seen = pd.Series(list(last), index=pd.Index(list(keys), dtype="object"), dtype="int64")
        if state.hasTimedOut:
            keep(state, seen)
            return
        rows = pd.concat([frame[[name, row_id, "ts", "__at"]] for frame in frames]).sort_values([name, "__at", row_id], ignore_index=True)
        first = rows[name].ne(rows[name].shift(1))
        before = rows["__at"].shift(1).where(~first, rows[name].map(seen))
        new = before.isna() | (rows["__at"] - before > pause)
        newest = rows.groupby(name, sort=False)["__at"].max()
        keep(state, pd.concat([seen, newest]).groupby(level=0).max())
        yield rows.loc[new, [name, row_id, "ts"]]

    return (
        keyed.withWatermark("ts", lateness).groupBy("__bucket")
        .applyInPandasWithState(
            step, schema, T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("last", T.ArrayType(T.LongType()))]),
            "append", GroupStateTimeout.EventTimeTimeout)
    )
