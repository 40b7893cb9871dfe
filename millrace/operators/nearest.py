"""Best-scoring rows for every query: vector and token-set similarity, k-means picks.

Every (row, query) score has to be computed once, so the work is laid out in
blocks and done with matrix products on Arrow batches:

* few queries (measured) are sent to every task; rows stream past them where they
  are, and each task passes on its ``k`` best rows per query;
* many queries are hashed into blocks, rows into blocks of their own, and every
  pair of blocks is one task, again passing on only its ``k`` best.

The last step ranks those partial results per query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.keys import hash_key
from ..session import staged
from .centers import GROUPED_FROM, Centers
from .order import top_k

MAX_SENT_BYTES = 256 * 2**20  # all query vectors (as doubles) or token lists together
ROWS_PER_BLOCK = 50_000
QUERIES_PER_BLOCK = 5_000
SCORES_AT_ONCE = 1_000_000
QUERIES_AT_ONCE = 2_000  # of one matrix product
DIGITS = 12  # significant digits that decide a rank, so summation order cannot decide a tie
PAIRS_AT_ONCE = 100_000  # (row, query) pairs whose differences are held at once

Scorer = Callable[[list], Callable[[list], np.ndarray]]


def _distance_scorer() -> Scorer:
    pairs_at_once = PAIRS_AT_ONCE

    def prepare(queries: list) -> Callable[[list], np.ndarray]:
        q = np.asarray([np.asarray(v, dtype="float64") for v in queries]) if isinstance(queries, list) else queries
        middle = q.mean(axis=0)

        def score(rows: list) -> np.ndarray:
            # around the queries' middle, where little cancels; ``within`` bounds the error and ``exact`` settles the rest
            x = np.asarray([np.asarray(v, dtype="float64") for v in rows])
            near, asked = x - middle, q - middle
            squares = (near * near).sum(axis=1)[:, None] + (asked * asked).sum(axis=1)[None, :]
            return -np.maximum(squares - 2 * (near @ asked.T), 0.0)

        def within(rows: list) -> np.ndarray:
            """How far a score may be from the true one: rounding of the vectors, of the middle and of the sums."""
            x = np.asarray([np.asarray(v, dtype="float64") for v in rows])
            size = np.abs(x).max(axis=1, initial=0.0)[:, None] + np.abs(q).max(axis=1, initial=0.0)[None, :] + np.abs(middle).max(initial=0.0)
            return 16 * (x.shape[1] + 4) ** 2 * np.finfo("float64").eps * size * size

        def exact(rows: list, picked: np.ndarray, asked: np.ndarray) -> np.ndarray:
            """Negative squared distances of pairs of a row and a query from the differences."""
            x = np.asarray([np.asarray(v, dtype="float64") for v in rows])
            parts = [slice(at, at + pairs_at_once) for at in range(0, len(picked), pairs_at_once)]
            return np.concatenate([np.zeros(0), *(-((x[picked[p]] - q[asked[p]]) ** 2).sum(axis=1) for p in parts)])

        score.exact, score.within = exact, within
        return score

    return prepare


def _jaccard_scorer() -> Scorer:
    """Shared items are counted through an index from item to the queries holding it, some hits at a time."""
    hits_at_once = SCORES_AT_ONCE

    def prepare(queries: list) -> Callable[[list], np.ndarray]:
        width = len(queries)
        number: dict[Any, int] = {}
        pairs = [(number.setdefault(item, len(number)), q) for q, items in enumerate(queries) for item in set(items)]
        pairs.sort()
        holders = np.asarray([q for _, q in pairs], dtype="int64")
        counts = np.bincount(np.asarray([i for i, _ in pairs], dtype="int64"), minlength=len(number))
        starts = np.concatenate([[0], np.cumsum(counts)])
        sizes = np.asarray([len(set(items)) for items in queries], dtype="float64")

        def score(rows: list) -> np.ndarray:
            row_sizes = np.asarray([len(items) for items in rows], dtype="float64")
            known = [(r, number[item]) for r, items in enumerate(rows) for item in items if item in number]
            shared = np.zeros(len(rows) * width)
            if known:
                at, items = np.asarray(known, dtype="int64").T
                upto = np.cumsum(counts[items])
                for part in np.split(np.arange(len(items)), np.searchsorted(upto, np.arange(hits_at_once, upto[-1], hits_at_once))):
                    repeats = counts[items[part]]  # an item adds at most one hit per query
                    offsets = np.arange(repeats.sum()) - np.repeat(np.cumsum(repeats) - repeats, repeats)
                    hits = np.repeat(at[part] * width, repeats) + holders[np.repeat(starts[items[part]], repeats) + offsets]
                    shared += np.bincount(hits, minlength=len(shared))
            shared = shared.reshape(len(rows), width)
            union = row_sizes[:, None] + sizes[None, :] - shared
            return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)

        return score

    return prepare


def _significant(digits: int) -> Callable[[np.ndarray], np.ndarray]:
    def significant(scores: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            scale = 10.0 ** (digits - 1 - np.floor(np.log10(np.abs(scores))))
            return np.where(np.isfinite(scale), np.round(scores * scale) / scale, scores)

    return significant


def _best_products(k: int, cosine: bool, names: tuple[str, str, str]) -> Callable:
    """As ``_best_of``, by matrix products: only scores that may be among the k best so far are rounded and ranked.

    A product is one tile of rows and queries; the k-th best score of each query, less what rounding
    may change, rules out nearly all of a tile in one comparison.
    """
    digits, at_once, wide = DIGITS, SCORES_AT_ONCE, QUERIES_AT_ONCE
    significant = _significant(digits)
    query_name, row_name, score_name = names

    def matrix(values: list) -> np.ndarray:
        x = values if isinstance(values, np.ndarray) else np.asarray([np.asarray(v, dtype="float64") for v in values])
        if not cosine:
            return x
        lengths = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.divide(x, lengths, out=np.zeros_like(x), where=lengths > 0)

    def best(query_ids: list, queries: list, batches: Iterator[tuple[list, list]]) -> pd.DataFrame:
        q = matrix(queries)
        width, found = len(query_ids), 0
        top_scores = np.full((width, k), -np.inf)
        top_ids = np.empty((width, k), dtype=object)
        step = max(1, at_once // max(1, min(width, wide)))
        for ids, values in batches:
            present = [i for i, value in enumerate(values) if value is not None]
            ids, values = [ids[i] for i in present], [values[i] for i in present]
            if not ids:
                continue
            x, names_of = matrix(values), np.empty(len(ids), dtype=object)
            names_of[:] = ids
            for start in range(0, len(ids), step):
                rows, own = x[start : start + step], names_of[start : start + step]
                more = min(k, found + len(rows))
                for at in range(0, width, wide):
                    scores = rows @ q[at : at + wide].T
                    least = top_scores[at : at + wide, k - 1] if found >= k else np.full(scores.shape[1], -np.inf)
                    if found < k <= len(rows):
                        least = np.partition(scores, len(rows) - k, axis=0)[len(rows) - k]
                        least = np.where(np.isnan(least), -np.inf, least)
                    low = least - np.where(np.isfinite(least), 10.0 ** (1 - digits) * np.abs(least), 0.0)
                    row, asked = np.nonzero(~(scores < low[None, :]))
                    if not len(row):
                        continue
                    touched = np.unique(asked)
                    all_queries = np.concatenate([np.repeat(touched, found), asked])
                    all_scores = np.concatenate([top_scores[at + touched, :found].ravel(), significant(scores[row, asked])])
                    all_ids = np.concatenate([top_ids[at + touched, :found].ravel(), own[row]])
                    order = np.argsort(all_ids, kind="stable")
                    order = order[np.lexsort((-all_scores[order], all_queries[order]))]  # ties stay in the order of ids
                    ranked = all_queries[order]
                    place = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
                    kept = place < more
                    top_scores[at + ranked[kept], place[kept]] = all_scores[order[kept]]
                    top_ids[at + ranked[kept], place[kept]] = all_ids[order[kept]]
                found = more
        return pd.DataFrame({
            query_name: [query for query in query_ids for _ in range(found)],
            row_name: list(top_ids[:, :found].ravel()), score_name: top_scores[:, :found].ravel()})

    return best


def _best_vectors(k: int, similarity: str, names: tuple[str, str, str]) -> Callable:
    """``_best_of`` for vectors."""
    return _best_of(k, _distance_scorer(), names) if similarity == "l2" else _best_products(k, similarity == "cosine", names)


def _best_of(k: int, scorer: Scorer, names: tuple[str, str, str]) -> Callable:
    """``(query_ids, queries, batches) -> frame`` with the k best rows per query."""
    digits, at_once = DIGITS, SCORES_AT_ONCE
    significant = _significant(digits)
    query_name, row_name, score_name = names

    def best(query_ids: list, queries: list, batches: Iterator[tuple[list, list]]) -> pd.DataFrame:
        score = scorer(queries)
        width = len(queries)
        step = max(1, at_once // max(1, width))
        top_scores = np.full((0, width), -np.inf)
        top_ids = np.empty((0, width), dtype=object)
        for ids, values in batches:
            present = [i for i, value in enumerate(values) if value is not None]
            if len(present) < len(ids):
                ids, values = [ids[i] for i in present], [values[i] for i in present]
            for start in range(0, len(ids), step):
                part = ids[start : start + step]
                exact = getattr(score, "exact", None)
                order = sorted(range(len(part)), key=part.__getitem__)
                part = np.asarray([part[i] for i in order], dtype=object)
                own = [values[start + i] for i in order]
                scores = score(own)
                if exact:
                    # all rows that may be among the k best count with their exact scores, the others not at all
                    error = score.within(own)
                    few = min(k, len(part))
                    least = np.partition(scores - error, len(part) - few, axis=0)[len(part) - few]
                    near = scores + error >= least - 10.0 ** (1 - digits) * np.abs(least)
                    near |= ~np.isfinite(scores + error)
                    rows_near, asked_near = np.nonzero(near)
                    scores = np.full(scores.shape, -np.inf)
                    scores[rows_near, asked_near] = significant(exact(own, rows_near, asked_near))
                else:
                    scores = significant(scores)
                picked_scores, picked_ids = [top_scores], [top_ids]
                for _ in range(min(k, len(part))):
                    first = scores.argmax(axis=0)
                    picked_scores.append(scores[first, np.arange(width)][None, :])
                    picked_ids.append(part[first][None, :])
                    scores[first, np.arange(width)] = -np.inf
                all_scores = np.concatenate(picked_scores)
                all_ids = np.concatenate(picked_ids)
                by_id = np.argsort(all_ids, axis=0, kind="stable")
                all_scores = np.take_along_axis(all_scores, by_id, axis=0)
                all_ids = np.take_along_axis(all_ids, by_id, axis=0)
                ranked = np.argsort(-all_scores, axis=0, kind="stable")[:k]
                top_scores = np.take_along_axis(all_scores, ranked, axis=0)
                top_ids = np.take_along_axis(all_ids, ranked, axis=0)
        found = top_scores.shape[0]
        return pd.DataFrame(
            {
                query_name: [q for q in query_ids for _ in range(found)],
                row_name: list(top_ids.T.ravel()),
                score_name: top_scores.T.ravel(),
            }
        )

    return best


def best_rows(
    rows: DataFrame, queries: DataFrame, row_id: str, query_id: str, row_value: str, query_value: str,
    similarity: str = "cosine", k: int = 1, max_sent_bytes: int = MAX_SENT_BYTES,
) -> DataFrame:
    """The ``k`` most similar rows per query: ``query_id, row_id, score, rank``.

    Rows and queries without a value take no part.

    ``similarity`` is cosine, dot_product, max_inner_product, l2 (score = negative
    squared distance) or jaccard (over token lists).  Exact; ties go to the smaller
    row id.  Ids are unique on both sides.
    """
    if similarity not in ("cosine", "dot_product", "max_inner_product", "l2", "jaccard"):
        raise ValueError(f"unknown similarity: {similarity}")
    as_set = F.array_distinct if similarity == "jaccard" else F.col
    given = rows.select(F.col(row_id).alias("__row"), as_set(row_value).alias("__value"))
    asked = queries.where(F.col(query_value).isNotNull()).select(
        F.col(query_id).alias("__query"), as_set(query_value).alias("__asked")
    )
    schema = T.StructType(
        [
            T.StructField("__query", asked.schema["__query"].dataType),
            T.StructField("__row", given.schema["__row"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    columns = ("__query", "__row", "score")
    best = _best_of(k, _jaccard_scorer(), columns) if similarity == "jaccard" else _best_vectors(k, similarity, columns)
    width = F.octet_length(F.to_json("__asked")) if similarity == "jaccard" else F.size("__asked") * 8
    measured = asked.agg(
        F.count("*").alias("asked"), F.coalesce(F.sum(width), F.lit(0)).alias("sent")
    ).first()
    if measured["asked"] == 0:
        partial = rows.sparkSession.createDataFrame([], schema)
    elif measured["sent"] <= max_sent_bytes:
        partial = _against_sent(given, asked, best, schema)
    else:
        partial = _against_blocks(given, asked, best, schema, measured["asked"])
    ranked = top_k(partial, ["__query"], "score", "__row", k)
    return ranked.select(
        F.col("__query").alias(query_id), F.col("__row").alias(row_id), "score", "rank"
    )


def _against_sent(given: DataFrame, asked: DataFrame, best: Callable, schema: T.StructType) -> DataFrame:
    """Queries of a measured size go to every task; rows stay where they are."""
    table = asked.orderBy("__query").toArrow()
    values = table.column("__asked").combine_chunks()
    if pa.types.is_floating(values.type.value_type):
        asked_values = values.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(values), -1)
    else:
        asked_values = values.to_pylist()
    sent = given.sparkSession.sparkContext.broadcast((table.column("__query").to_pylist(), asked_values))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, values = sent.value
        batches = ((f["__row"].tolist(), f["__value"].tolist()) for f in frames)
        yield best(ids, values, batches)

    return given.mapInPandas(scored, schema)


def _against_blocks(
    given: DataFrame, asked: DataFrame, best: Callable, schema: T.StructType, query_count: int
) -> DataFrame:
    """Every block of rows meets every block of queries in a task of its own."""
    row_blocks = max(1, -(-given.count() // ROWS_PER_BLOCK))
    query_blocks = max(1, -(-query_count // QUERIES_PER_BLOCK))
    placed_rows = given.withColumns(
        {
            "__rb": F.pmod(F.xxhash64("__row"), F.lit(row_blocks)),
            "__qb": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))),
        }
    )
    placed_queries = asked.withColumns(
        {
            "__qb": F.pmod(F.xxhash64("__query"), F.lit(query_blocks)),
            "__rb": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(row_blocks - 1).cast("bigint"))),
        }
    )

    def scored(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"__query": [], "__row": [], "score": []})
        return best(
            queries["__query"].tolist(), queries["__asked"].tolist(),
            iter([(rows["__row"].tolist(), rows["__value"].tolist())]),
        )

    return (
        placed_rows.groupBy("__rb", "__qb")
        .cogroup(placed_queries.groupBy("__rb", "__qb"))
        .applyInPandas(scored, schema)
    )


def nearest_rows(
    rows: DataFrame, centers: DataFrame, row_id: str, center_id: str, vector: str, center_vector: str,
    max_sent_bytes: int = MAX_SENT_BYTES,
) -> DataFrame:
    """The nearest row (squared distance) to every center: ``center_id, row_id, d2``.

    Two centers may share a row.
    """
    found = best_rows(
        rows, centers, row_id, center_id, vector, center_vector, "l2", 1, max_sent_bytes
    )
    # -0.0 (an exact hit) becomes 0.0
    return found.select(center_id, row_id, (F.lit(0.0) - F.col("score")).alias("d2"))


def _nearest_center(sent, row_id: str | None = None) -> Callable:
    """Per task: how far the rows of each center lie from it in sum, or with ``row_id`` the nearest row of each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Centers(sent.value)
        totals: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        best: dict[int, tuple] = {}
        for frame in frames:
            if not len(frame):
                continue
            x = np.asarray([np.asarray(v, dtype="float64") for v in frame["__value"]])
            own, d2 = found.nearest(x)
            if row_id:
                for cluster, pair in zip(own.tolist(), zip(d2.tolist(), frame[row_id].tolist(), strict=True), strict=True):
                    best[cluster] = min(best.get(cluster, pair), pair)
                continue
            order = np.argsort(own, kind="stable")
            used, starts = np.unique(own[order], return_index=True)
            away = np.add.reduceat((x - found.centers[own])[order], starts, axis=0)
            sizes = np.diff(np.append(starts, len(own)))
            for cluster, total, n in zip(used.tolist(), away, sizes.tolist(), strict=True):
                totals[cluster] = totals.get(cluster, 0.0) + total
                counts[cluster] = counts.get(cluster, 0) + n
        if not totals and not best:  # an empty partition
            return
        if row_id:
            yield pd.DataFrame([(c, i, d) for c, (d, i) in best.items()], columns=["cluster", row_id, "d2"])
        else:
            yield pd.DataFrame({"cluster": np.fromiter(totals, "int32"), "n": np.fromiter(counts.values(), "int64"), "total": list(totals.values())})

    return run


def _by_region(given: DataFrame, row_id: str, centers: np.ndarray) -> DataFrame:
    """The rows stored by the group of their nearest center, so that a task meets few centers.

    Tasks then pass on little more than one sum per center altogether, instead of
    one per center and task.  Ranges also cut within a group, so a group that
    holds most rows is spread too.
    """
    sent = given.sparkSession.sparkContext.broadcast(centers)

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Centers(sent.value)
        region = np.zeros(len(found.centers), "int32")
        for number, members in enumerate(found.groups):
            region[members] = number
        for frame in frames:
            x = np.asarray([np.asarray(v, dtype="float64") for v in frame["__value"]]).reshape(len(frame), -1)
            own = found.nearest(x)[0] if len(frame) else np.zeros(0, int)
            yield frame.assign(__region=region[own], __center=own.astype("int32"))

    schema = T.StructType([*given.schema.fields, *T.StructType.fromDDL("__region int, __center int").fields])
    regions = given.mapInPandas(placed, schema).repartitionByRange("__region", "__center", hash_key(V.SEED, row_id))
    return staged(regions.drop("__region", "__center"), "clusters")


def center_sums(given: DataFrame, centers: np.ndarray) -> tuple[DataFrame, Any]:
    """(cluster, n, total): per task and center how many rows are nearest to it and the sum of their differences; and what was sent."""
    sent = given.sparkSession.sparkContext.broadcast(centers)
    return given.mapInPandas(_nearest_center(sent), "cluster int, n long, total array<double>"), sent


def cluster_centers(
    rows: DataFrame, row_id: str, vector: str, k: int = V.CLUSTERS, iterations: int = V.CLUSTER_ITERATIONS,
    seed: int = V.SEED,
) -> np.ndarray:
    """k-means centers: Lloyd steps from the k rows whose hashed ids are least.

    Every step is one pass: each row goes to its nearest center, exactly (ties to
    the smaller number); tasks add up the differences of the rows to their center, one sum per
    center met is shuffled, and the k new centers come to the driver.  From some
    hundred centers on, centers form groups, rows are compared only with
    groups that can hold the nearest, and rows are stored once by group, so tasks
    meet few centers each.  A center without rows stays where it is.  Rows without a vector take no part.
    """
    given = rows.where(F.col(vector).isNotNull()).select(row_id, F.col(vector).cast("array<double>").alias("__value"))
    first = given.orderBy(hash_key(seed, row_id), row_id).limit(k).select("__value").toArrow()
    centers = np.asarray([np.asarray(v, dtype="float64") for v in first.column("__value").to_pylist()], dtype="float64")
    if len(centers) >= GROUPED_FROM and iterations > 1:
        given = _by_region(given, row_id, centers)

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.asarray(t) for t in parts["total"]], axis=0)
        return pd.DataFrame({"cluster": parts["cluster"].iloc[:1], "step": [total / parts["n"].sum()]})

    for _ in range(iterations if len(centers) else 0):
        sums, sent = center_sums(given, centers)
        steps = sums.groupBy("cluster").applyInPandas(added, "cluster int, step array<double>").toArrow()  # k rows
        sent.destroy()
        moved = centers.copy()
        for cluster, step in zip(steps.column("cluster").to_pylist(), steps.column("step").to_pylist(), strict=True):
            moved[cluster] += step
        if np.array_equal(moved, centers):
            break
        centers = moved
    return centers


def diverse_rows(
    rows: DataFrame, row_id: str, vector: str, k: int = V.CLUSTERS,
    iterations: int = V.CLUSTER_ITERATIONS, seed: int = V.SEED, mode: str = "exact",
    distinct: bool = False,
) -> DataFrame:
    """One representative row per k-means cluster: ``cluster, row_id, d2``.

    ``exact`` looks for the row nearest to each center among all rows;
    ``assigned`` only among the rows of that cluster, which needs no second
    pass over all pairs but may differ.  ``distinct`` keeps a row that represents
    several clusters only once.
    """
    # k centers of fixed width: the model itself, whatever the number of rows
    found_centers = cluster_centers(rows, row_id, vector, k, iterations, seed)
    if not len(found_centers):
        return rows.sparkSession.createDataFrame([], T.StructType([T.StructField("cluster", T.IntegerType()), rows.schema[row_id], T.StructField("d2", T.DoubleType())]))
    offsets = np.arange(0, found_centers.size + 1, found_centers.shape[1], dtype="int32")
    centers = rows.sparkSession.createDataFrame(
        pa.table(
            {
                "cluster": np.arange(len(found_centers), dtype="int32"),
                "center": pa.ListArray.from_arrays(offsets, found_centers.ravel()),
            }
        )
    )
    if mode == "assigned":
        given = rows.where(F.col(vector).isNotNull()).select(row_id, F.col(vector).cast("array<double>").alias("__value"))
        schema = T.StructType([T.StructField("cluster", T.IntegerType()), rows.schema[row_id], T.StructField("d2", T.DoubleType())])
        sent = rows.sparkSession.sparkContext.broadcast(found_centers)
        found = given.mapInPandas(_nearest_center(sent, row_id), schema).groupBy("cluster").agg(
            F.min(F.struct("d2", F.col(row_id))).alias("best")
        ).select("cluster", f"best.{row_id}", "best.d2")
    else:
        found = nearest_rows(rows, centers, row_id, "cluster", vector, "center")
    if distinct:
        first = found.groupBy(row_id).agg(F.min(F.struct("cluster", "d2")).alias("best"))
        found = first.select("best.cluster", row_id, "best.d2")
    return found
