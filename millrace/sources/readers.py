"""Reading named datasets and files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    path: str
    format: str = "parquet"
    schema: str | None = None
    options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Catalog:
    """Dataset names (with an optional configuration) and where they are stored."""

    sources: dict[str, Source]

    @classmethod
    def of_folder(cls, folder: str, *names: str) -> Catalog:
        """One Parquet table per name in one folder."""
        return cls({name: Source(f"{folder}/{name}.parquet") for name in names})

    def load(
        self, spark: SparkSession, name: str, config: str | None = None, split: str | None = None
    ) -> DataFrame:
        """All splits of a dataset, or one.

        The split is a partition column, so asking for one reads only its files.
        """
        source = self.sources[f"{name}/{config}" if config else name]
        reader = spark.read.format(source.format).options(**source.options)
        if source.schema:
            reader = reader.schema(source.schema)
        df = reader.load(source.path)
        return df if split is None else df.where(F.col("split") == split)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; quoted fields may hold line breaks and doubled quotes.

    Empty fields are null.  A file with line breaks inside fields cannot be split,
    so large tables should come as many files.
    """
    return spark.read.csv(
        path, schema=schema, header=True, multiLine=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def read_json_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array of rows."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_json_batches(spark: SparkSession, folder: str, schema: str, split: str | None = None, lines: bool = False) -> DataFrame:
    """``{split}_batch_{number}.json`` with ``split`` and ``batch_no`` from their names: files of one JSON array, or with ``lines`` folders (or files) of JSON rows.

    ``split`` reads only the batches of that name.
    """
    path = F.col("_metadata.file_path")
    pattern = r"([^/]*)_batch_(\d+)\.json(?:/[^/]*)?$"
    return (
        spark.read.schema(schema).json(f"{folder}/{split or '*'}_batch_*.json", multiLine=not lines)
        .withColumns(
            {
                "split": F.url_decode(F.regexp_extract(path, pattern, 1)),
                "batch_no": F.regexp_extract(path, pattern, 2).cast("int"),
            }
        )
    )
