"""Exact top-k inner products through a pivot-distance index.

Inner product becomes distance: with M the largest squared length, a vector v gets
one more component sqrt(M - |v|^2) and a query 0, so |q - v|^2 = |q|^2 + M - 2 q.v
and the best scores are the nearest vectors. Vectors are keyed by their nearest
pivot and their distance to it, and each pivot's cell is cut along that distance
into rings of bounded size.

Every query first scores the rings nearest to it, which gives the score its k-th
neighbour has at least. It then goes to those rings only that the triangle
inequality does not exclude: |d(q, p) - d(v, p)| is no more than |q - v|. Within a
ring's task it expands from its own distance outwards, both ways, and stops where
the bound passes what it holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflux.llm.common import cut_lineage, ship_package

#: Pivots are a fixed sample, by a hash of the id; they steer the work and never the result.
MOST_PIVOTS = 64
RING_ROWS = 8_192
STEP_ROWS = 1_024
#: Above the rounding of distances, which are of the order of the vectors' lengths.
SLACK = 1e-6


def quantised(vector: Column | str, factor: int = 64) -> Column:
    """floor(factor * x) of each component as ``array<double>``; null where the vector is null or holds null or non-finite values.

    Doubles hold these integers exactly up to 2**53.
    """
    column = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(math.inf)))
    return F.when(column.isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(column, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("double")))


def _matrix(vectors: list[np.ndarray] | pd.Series, dims: int) -> np.ndarray:
    """Rows of equal length; a shorter vector is followed by zeros."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _distances(rows: np.ndarray, pivots: np.ndarray, largest: float, lifted: bool) -> np.ndarray:
    """Distance of each row to each pivot in the lifted space; ``lifted`` rows are vectors, the others queries."""
    inner = rows @ pivots.T
    own = (rows * rows).sum(axis=1)
    if lifted:
        squared = 2 * largest - 2 * inner - 2 * np.sqrt(np.maximum(largest - own, 0))[:, None] * np.sqrt(
            np.maximum(largest - (pivots * pivots).sum(axis=1), 0))[None, :]
    else:
        squared = own[:, None] + largest - 2 * inner
    return np.sqrt(np.maximum(squared, 0))


def _with_distances(rows: DataFrame, pivots: np.ndarray, largest: float, lifted: bool) -> DataFrame:
    """``rows(id, v)`` with ``d``, the distances to all pivots."""
    def distances(column: pa.Array) -> pa.Array:
        table = _distances(_matrix([np.asarray(v) for v in column.to_pylist()], pivots.shape[1]), pivots, largest, lifted)
        offsets = np.arange(len(table) + 1, dtype=np.int32) * len(pivots)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.ravel()))

    return rows.withColumn("d", F.arrow_udf(distances, "array<double>")("v"))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def search_ring(ring: tuple[np.ndarray, np.ndarray, np.ndarray], queries: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
                k: int, largest: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query place, ids, scores) of what may be among the query's k best.

    ``ring``: ids, matrix and distances to the pivot, sorted by distance. ``queries``:
    ids, matrix, distances to the pivot and the score that the k-th neighbour has at least.
    """
    ids, rows, at = ring
    query_ids, vectors, own, floors = queries
    cuts = list(range(0, len(ids), STEP_ROWS)) + [len(ids)]
    lows, highs = at[cuts[:-1]], at[np.array(cuts[1:]) - 1]
    lengths = (vectors * vectors).sum(axis=1)
    held_ids = [np.zeros(0, np.int64)] * len(query_ids)
    held = [np.zeros(0)] * len(query_ids)
    floors = floors.copy()
    gaps = np.maximum(0, np.maximum(lows[None, :] - own[:, None], own[:, None] - highs[None, :]))
    order = np.argsort(gaps, axis=1, kind="stable")
    going = np.arange(len(query_ids))
    for turn in range(len(lows)):
        gap = gaps[going, order[going, turn]]
        reach = np.sqrt(np.maximum(lengths[going] + largest - 2 * floors[going], 0))
        going = going[gap <= reach * (1 + SLACK) + SLACK]
        if not len(going):
            break
        step = order[going, turn]
        for s in np.unique(step):
            some = going[step == s]
            a, b = cuts[s], cuts[s + 1]
            scores = vectors[some] @ rows[a:b].T
            for i, line in zip(some.tolist(), scores):
                able = np.flatnonzero((line >= floors[i]) & (ids[a:b] != query_ids[i]))
                if len(able):
                    all_ids = np.concatenate([held_ids[i], ids[a:b][able]])
                    all_scores = np.concatenate([held[i], line[able]])
                    best = _best(all_ids, all_scores, k)
                    held_ids[i], held[i] = all_ids[best], all_scores[best]
                    if len(best) == k:
                        floors[i] = max(floors[i], held[i][-1])
    for i in range(len(query_ids)):
        if len(held_ids[i]):
            yield i, held_ids[i], held[i]


def exact_topk(vectors: DataFrame, queries: Column | str, k: int = 20, factor: int = 64,
               id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query row with all other rows.

    ``queries`` is the condition that marks query rows. Vectors are quantised first
    (see ``quantised``); those without a quantised form take no part, nor do rows
    without an id. Vectors of different lengths are compared as if zeros followed
    the shorter one. Ties go to the smaller id; rows that share an id are one
    vector, the greatest by component order. A query with fewer than k candidates has all of them.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    condition = F.expr(queries) if isinstance(queries, str) else queries
    rows = cut_lineage(vectors.withColumn("__query", condition)
                       .select(F.col(id_column).cast("long").alias("id"), quantised(vector_column, factor).alias("v"), "__query")
                       .where("id is not null and v is not null")
                       .groupBy("id").agg(F.max("v").alias("v"), F.max(F.coalesce("__query", F.lit(False))).alias("is_query")))
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    known = rows.agg(F.count("*").alias("n"), F.max(length).alias("largest"), F.max(F.size("v")).alias("dims")).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not known.n or not known.dims:
        return spark.createDataFrame([], result)
    largest, dims = float(known.largest), int(known.dims)
    wanted = max(1, min(MOST_PIVOTS, math.isqrt(known.n) // 4))
    chosen = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    pivots = np.unique(_matrix([np.asarray(r.v) for r in chosen], dims), axis=0)

    # Rings: each cell is cut at quantiles of its distances; equal distances are told apart by a hash of the id, so
    # a cell that holds a third of all rows, or equal vectors, is cut like any other.
    placed = _with_distances(rows.select("id", "v"), pivots, largest, True)
    keyed = cut_lineage(placed.select("id", "v", (F.array_position("d", F.array_min("d")) - 1).cast("int").alias("pivot"),
                                      F.array_min("d").alias("distance"),
                                      (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))).alias("tie")))
    cells = keyed.groupBy("pivot").agg(
        F.ceil(F.count("*") / RING_ROWS).cast("int").alias("n"),
        F.percentile_approx("distance", [i / 64 for i in range(1, 64)], 1_000).alias("steps"))
    bucket = F.size(F.filter("steps", lambda s: s < F.col("distance"))) + F.col("tie")
    ringed = cut_lineage(keyed.join(F.broadcast(cells), "pivot")  # a row for each of at most MOST_PIVOTS pivots
                         .withColumn("ring", F.least(F.col("n") - 1, F.floor(bucket / 64 * F.col("n")).cast("int")))
                         .select("id", "v", "pivot", "distance", "ring"))
    directory = cut_lineage(ringed.groupBy("pivot", "ring").agg(F.min("distance").alias("low"), F.max("distance").alias("high")))

    asked = _with_distances(rows.where("is_query").select("id", "v"), pivots, largest, False)
    seekers = cut_lineage(asked.select("id", "v", F.explode(F.transform("d", lambda d, i: F.struct(i.alias("pivot"), d.alias("own")))).alias("p"))
                          .select("id", "v", "p.pivot", "p.own"))
    visits = seekers.join(directory, "pivot").withColumn("gap", F.greatest(F.lit(0.0), F.col("low") - F.col("own"), F.col("own") - F.col("high")))

    def score(pairs: DataFrame) -> DataFrame:
        def search(ring: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
            if ring.empty or asking.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            ring = ring.sort_values(["distance", "id"])
            found = list(search_ring(
                (ring["id"].to_numpy(), _matrix(ring["v"], dims), ring["distance"].to_numpy()),
                (asking["id"].to_numpy(), _matrix(asking["v"], dims), asking["own"].to_numpy(), asking["floor"].to_numpy()), k, largest))
            names = asking["id"].to_numpy()
            return pd.DataFrame({"query_id": np.concatenate([np.repeat(names[i], len(x)) for i, x, _ in found] or [[]]).astype(np.int64),
                                 "vec_id": np.concatenate([x for _, x, _ in found] or [[]]).astype(np.int64),
                                 "score": np.concatenate([s for _, _, s in found] or [[]]).astype(np.int64)})

        # Queries of a ring are dealt to blocks, so neither side of a group grows with the data.
        blocks = F.lit(max(1, math.ceil(known.n / (200 * RING_ROWS))))
        block = F.pmod(F.xxhash64("id"), blocks)
        asking = pairs.withColumn("block", block).select("pivot", "ring", "block", "id", "v", "own", "floor")
        copies = ringed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
        return copies.groupBy("pivot", "ring", "block").cogroup(asking.groupBy("pivot", "ring", "block")).applyInPandas(
            search, "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    nearest = Window.partitionBy("id").orderBy("gap", "own", "pivot", "ring")
    first = visits.withColumn("turn", F.row_number().over(nearest)).where("turn = 1").withColumn("floor", F.lit(-math.inf)).drop("turn")
    opening = cut_lineage(score(first))
    floors = (opening.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
              .select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor")))
    squared = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    seen = first.select("id", "pivot", "ring")
    rest = (visits.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(-math.inf)))
            .where(F.col("gap") <= F.sqrt(F.greatest(F.lit(0.0), squared + largest - 2 * F.col("floor"))) * (1 + SLACK) + SLACK)
            .join(seen, ["id", "pivot", "ring"], "left_anti"))
    every = opening.union(score(rest))
    return (every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
