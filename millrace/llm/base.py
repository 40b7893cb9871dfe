"""Registry of the queries of this folder, and how they read their tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL where there is any."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_hash(id_column, parts: int):
    """crc32 of the id as text, modulo ``parts``; null ids count as the text ''."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def release() -> None:
    """Give memory that a task no longer uses back to the system: Python workers go on to serve later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library; only the size of idle workers differs
        pass


def with_arrays(df: DataFrame, added: dict[str, str], make: Callable, replaced: tuple[str, ...] = (), dropped: tuple[str, ...] = ()) -> DataFrame:
    """Add columns that Python computes batch by batch; all others pass through as Arrow, nulls included.

    ``make()`` is called once per task and returns a function of a record batch
    that gives one list or array per column of ``added`` (name to type), then
    one per column of ``replaced``.  A column of ``df`` with an added name, in
    whatever case, gives way to the new one; the function still sees it.
    """
    new_names = {name.lower() for name in added}
    kept = [f for f in df.schema.fields if f.name not in dropped and f.name.lower() not in new_names]
    new = [] if not added else T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in added.items())).fields
    schema = T.StructType([*kept, *new])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            values = dict(zip([*added, *replaced], compute(batch), strict=True))
            columns = [
                pa.array(values[f.name], f.type) if f.name in values else batch.column(f.name).cast(f.type) for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            del values, columns, batch
        del compute
        release()

    return df.mapInArrow(run, schema)
