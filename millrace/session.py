"""Session helpers: a local session for tests and a place for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "millrace") -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the caller brings a session; nothing in the package sets
    session options.
    """
    width = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(width))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "4m")  # small files are still read by all cores
        .config("spark.sql.files.openCostInBytes", "256k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


@cache
def _own_folder() -> str:
    """One temporary folder for this process; it goes with the process."""
    root = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table or a stream checkpoint.

    The folder comes from ``spark.checkpoint.dir``, which every executor can
    reach.  Only a local session without that setting gets a folder of this
    machine; a cluster without it is an error rather than a silent local path.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _own_folder()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once and read back.

    For tables that several later passes read: each pass then reads only the
    columns it needs, and a lost executor does not bring the earlier work back.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
