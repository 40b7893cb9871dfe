"""A stored index for nearest vectors: rows in lists by their nearest center, searched list by list.

A search looks at the lists with the nearest centers first.  With ``exact`` it
goes on to every list whose distances leave room for a better row, so
the result is that of all comparisons; without, it stops after some lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.keys import hash_key
from ..session import staged
from .centers import Centers, squared
from .nearest import QUERIES_PER_BLOCK, ROWS_PER_BLOCK, _best_vectors, cluster_centers
from .order import top_k

LISTS = 4096  # most lists; their centers go to every task
STEPS = 8  # of the clustering that places the centers; any places give right results
SIMILARITIES = ("cosine", "l2")


def _unit(vector: str) -> Column:
    values = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    return F.when(norm > 0, F.transform(values, lambda x: x / norm)).otherwise(values)


def _kept(rows: DataFrame, vector: str) -> Column:
    """Single precision stays as it is, half as many bytes; scores are computed in doubles from it."""
    return F.col(vector) if rows.schema[vector].dataType == T.ArrayType(T.FloatType(), rows.schema[vector].dataType.containsNull) else F.col(vector).cast("array<double>")


def _placed(similarity: str, vector: str) -> Column:
    """What lists are made of: directions for cosine, the vectors themselves for l2."""
    return _unit(vector) if similarity == "cosine" else F.col(vector).cast("array<double>")


def _matrix(values: pd.Series) -> np.ndarray:
    return np.asarray([np.asarray(v, dtype="float64") for v in values]).reshape(len(values), -1) if len(values) else np.zeros((0, 0))


class VectorIndex:
    """Vectors under ``path``: table ``rows`` in one folder per list, table ``lists`` with what is known of each list."""

    def __init__(self, spark: SparkSession, path: str, similarity: str = "cosine"):
        if similarity not in SIMILARITIES:
            raise ValueError(f"not one of {SIMILARITIES}: {similarity}")
        self.spark, self.path, self.similarity = spark, path.rstrip("/"), similarity

    def build(self, rows: DataFrame, row_id: str, vector: str, lists: int | None = None, seed: int = V.SEED) -> VectorIndex:
        """Store the rows; those without a vector take no part.  ``lists`` defaults to the square root of the row count.

        A list that holds most rows is written by several tasks, and searched in parts.
        """
        given = rows.where(F.col(vector).isNotNull()).select(F.col(row_id).alias("id"), _kept(rows, vector).alias("vector"))
        given = staged(given.withColumn("placed", _placed(self.similarity, "vector")), "vector-rows")  # every step of the clustering reads them
        if lists is None:
            lists = min(LISTS, max(1, round(given.count() ** 0.5)))
        centers = cluster_centers(given, "id", "placed", lists, STEPS, seed)
        sent = self.spark.sparkContext.broadcast(centers)  # at most LISTS vectors

        def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = Centers(sent.value)
            for frame in frames:
                if len(frame):
                    placed = _matrix(frame["placed"])
                    own, d2 = found.nearest(placed)
                    yield frame[["id", "vector"]].assign(list=own.astype("int32"), away=np.sqrt(d2), norm=np.sqrt(squared(placed, 0.0)))

        fields = [f for f in given.schema.fields if f.name != "placed"]
        schema = T.StructType([*fields, *T.StructType.fromDDL("list int, away double, norm double").fields])
        stored = given.mapInPandas(assign, schema).repartitionByRange("list", hash_key(seed, "id"))
        stored.write.mode("overwrite").partitionBy("list").parquet(f"{self.path}/rows")
        found = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        stats = found.groupBy("list").agg(F.count("*").alias("n"), F.min("away").alias("low"), F.max("away").alias("high"), F.max("norm").alias("norm"))
        places = self.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "list int, center array<double>")
        stats.join(places, "list").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/lists")
        return self

    def _asked(self, queries: DataFrame) -> DataFrame:
        """(query, list, place, bound, reached): per query the lists by the distance of their centers, and the best score a list can hold."""
        stats = self.spark.read.parquet(f"{self.path}/lists").orderBy("list").toArrow().to_pandas()  # at most LISTS rows
        kind = queries.schema["query"].dataType
        sent = self.spark.sparkContext.broadcast((stats["list"].to_numpy(), _matrix(stats["center"]), *(stats[c].to_numpy() for c in ("low", "high", "norm"))))
        cosine = self.similarity == "cosine"

        def order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, centers, low, high, norm = sent.value
            step = max(1, 1_000_000 // max(1, centers.size))
            for frame in frames:
                for start in range(0, len(frame) if len(names) else 0, step):
                    part = frame.iloc[start : start + step]
                    x = _matrix(part["placed"])
                    away = np.sqrt(squared(x[:, None, :], centers[None, :, :]))
                    slack = 1e-9 * (1.0 + away + high[None, :])  # more than rounding adds up to
                    gap = np.maximum(0.0, np.maximum(away - high[None, :], low[None, :] - away) - slack)
                    own = squared(x, 0.0)
                    bound = (own[:, None] + (norm * norm)[None, :] - gap * gap) / 2 + 1e-9 if cosine else -gap * gap
                    place = np.argsort(np.argsort(away, axis=1, kind="stable"), axis=1)
                    yield pd.DataFrame({
                        "query": np.repeat(part["query"].to_numpy(), len(names)), "list": np.tile(names, len(part)),
                        "place": place.ravel().astype("int32"), "bound": bound.ravel(), "reached": np.repeat(part["reached"].to_numpy(), len(names))})

        schema = T.StructType([T.StructField("query", kind), *T.StructType.fromDDL("list int, place int, bound double, reached string").fields])
        # as text, in which no score and a score that is not a number stay two things
        return queries.select("query", "placed", F.col("reached").cast("string")).mapInPandas(order, schema).withColumn("reached", F.col("reached").cast("double"))

    def _looked_up(self, asked: DataFrame, queries: DataFrame, k: int) -> DataFrame:
        """(query, id, score): per query the k best rows of each part of each list asked for."""
        wanted = asked.select("query", "list")
        sizes = self.spark.read.parquet(f"{self.path}/lists").select("list", F.ceil(F.col("n") / ROWS_PER_BLOCK).alias("parts"))
        load = wanted.groupBy("list").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).alias("blocks")).join(sizes, "list")
        stored = self.spark.read.parquet(f"{self.path}/rows").select("id", "vector", F.col("list").cast("int").alias("list"))
        zero = F.lit(0).cast("bigint")
        rows = stored.join(load, "list").withColumn("part", F.expr("pmod(xxhash64(id), parts)")).withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
        mine = wanted.join(load, "list").withColumn("block", F.expr("pmod(xxhash64(query), blocks)")).withColumn("part", F.explode(F.sequence(zero, F.col("parts") - 1)))
        mine = mine.join(queries.select("query", "vector"), "query").select(F.col("list").alias("l"), F.col("part").alias("p"), F.col("block").alias("b"), "query", "vector")
        schema = T.StructType([T.StructField("query", queries.schema["query"].dataType), T.StructField("id", stored.schema["id"].dataType), T.StructField("score", T.DoubleType())])
        best = _best_vectors(k, self.similarity, ("query", "id", "score"))

        def scored(block: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
            if block.empty or questions.empty:
                return pd.DataFrame({"query": [], "id": [], "score": []})
            return best(questions["query"].tolist(), questions["vector"].tolist(), iter([(block["id"].tolist(), block["vector"].tolist())]))

        # a group is at most about ROWS_PER_BLOCK rows and QUERIES_PER_BLOCK queries
        return rows.groupBy("list", "part", "block").cogroup(mine.groupBy("l", "p", "b")).applyInPandas(scored, schema)

    def search(self, queries: DataFrame, query_id: str, vector: str, row_id: str, k: int = 1, probes: int = 4, exact: bool = False) -> DataFrame:
        """The ``k`` best rows per query: query_id, row_id, score, rank, ``probed`` (lists looked at); ties go to the smaller id.

        ``probes`` lists are looked at first.  Without ``exact`` the result is the best of
        them, which may miss rows of others.  With it, the k-th best score so far
        rules out the lists that cannot reach it, and the rest are looked at too.
        """
        asked = queries.where(F.col(vector).isNotNull()).select(F.col(query_id).alias("query"), _kept(queries, vector).alias("vector"))
        if self.spark.read.parquet(f"{self.path}/lists").isEmpty():
            return asked.where("false").select(F.col("query").alias(query_id), F.lit(None).cast("bigint").alias(row_id)).selectExpr("*", "0d AS score", "0 AS rank", "0L AS probed")
        asked = staged(asked.withColumn("placed", _placed(self.similarity, "vector")), "vector-queries")
        near = staged(self._asked(asked.withColumn("reached", F.lit(None))).where(F.col("place") < probes).select("query", "list"), "vector-lists")
        found = staged(self._looked_up(near, asked, k), "vector-scores")
        if exact:
            reached = top_k(found, ["query"], "score", "id", k).where(F.col("rank") == k).select("query", F.col("score").alias("reached"))
            far = self._asked(asked.join(reached, "query", "left")).where(F.col("place") >= probes)  # what is ruled out is not stored
            # scores are compared in so many digits that a bound has to give way a little
            far = staged(far.where(F.col("reached").isNull() | (F.col("bound") >= F.col("reached") - 1e-9 * F.abs("reached"))).select("query", "list"), "vector-more")
            found = found.union(self._looked_up(far, asked, k))
            near = near.union(far)
        probed = near.groupBy("query").agg(F.count("*").alias("probed"))
        best = top_k(found, ["query"], "score", "id", k).join(probed, "query")
        return best.select(F.col("query").alias(query_id), F.col("id").alias(row_id), "score", "rank", "probed")
