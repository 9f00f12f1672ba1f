"""Approximate nearest neighbours by collision counting over sorted single projections.

The largest inner product is the nearest point once every vector gets one more coordinate that makes all
norms equal (see `topk`), and the query is scaled to that norm. The index holds the vectors in blocks; per
block, each of `projections` orthogonal directions is one sorted array of projections. A search

1. opens, in every array, a window centred at the query's projection, and widens all windows by the same
   factor round after round (virtual rehashing), counting for each vector the windows that hold it;
2. verifies, on the original vectors in double precision, those in at least `threshold` of the windows;
3. stops in a block when the share `enough` of its vectors has been verified, and some for each of k, or all.

Every row is in the index. Blocks and groups of queries have bounded size, and a window over each query's
best rows of all blocks keeps the nearest k.

Defined cases: rows with a null id, and vectors that are null, zero or hold null or non-finite components,
take no part. Vectors of each length are searched by themselves. A repeated query id asks once per length, with
its smallest vector, and is ranked over all; rows that share the query's id are never its candidates; other repeated rows each
count. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medloom.llm.common import prepare, stored
from medloom.llm.topk import best_rows, lengths, lifted, matrix, usable

BLOCK_ROWS, QUERY_ROWS, PROJECTIONS = 8192, 1024, 64
#: Share of the windows a vector must be in; share of a block verified before a search may stop; first width
#: of half a window, in standard deviations of a difference; factor by which windows widen.
THRESHOLD, ENOUGH, FIRST_WIDTH, WIDEN = 0.70, 0.15, 0.75, 1.12
#: Vectors verified in a block, at least, per neighbour wanted.
PER_WANTED = 15


def directions(dim: int, n: int, seed: int = 7) -> np.ndarray:
    """n unit vectors, orthogonal in groups of `dim`."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0].T for _ in range(-(-n // dim))])[:n]


def verified(lines, order, asked, width, k, threshold, enough, exact):
    """One query in one block: positions whose count of collisions passed, with their exact measure.

    `lines` are the sorted projections, one line after the other, each lifted by `lift` above the last, so
    that one search finds all window ends; `order` are the vectors' positions in the same places.
    """
    n = len(order) // len(asked)
    counts, seen = np.zeros(n, np.int64), np.zeros(n, bool)
    low = high = np.searchsorted(lines, asked)
    first = np.arange(len(asked)) * n
    found, scores, done = [], [], 0
    while True:
        a = np.maximum(np.searchsorted(lines, asked - width), first)
        z = np.minimum(np.searchsorted(lines, asked + width, side="right"), first + n)
        low, high = np.clip(low, a, z), np.clip(high, a, z)
        ends = np.stack([a, low, high, z], axis=1).tolist()
        counts += np.bincount(np.concatenate([x for p, q, r, t in ends for x in (order[p:q], order[r:t])]), minlength=n)
        low, high = a, z
        pick = np.flatnonzero((counts >= threshold) & ~seen)
        seen[pick] = True
        found.append(pick)
        scores.append(exact(pick))
        done += len(pick)
        if done == n or done >= max(enough * n, PER_WANTED * k):
            return np.concatenate(found), np.concatenate(scores)
        width *= WIDEN


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", projections: int = PROJECTIONS,
    threshold: float = THRESHOLD, enough: float = ENOUGH, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Each query's k nearest found: query_id, rank, vec_id, score. `is_query` is a condition on the column `id`."""
    spark = vectors.sparkSession
    prepare(spark)
    squared = F.aggregate("x", F.lit(0.0), lambda a, c: a + c * c)
    whole = usable(vectors, id_col, vec_col).filter(F.exists("x", lambda c: c != 0))
    found = [
        _of_length(whole.filter(F.size("x") == dim), is_query, dim, bound, total, k, projections, threshold, enough, block_rows, query_rows)
        for dim, bound, total in lengths(whole, squared)
    ]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_length(
    whole: DataFrame, is_query: Column, dim: int, bound: float, total: int, k: int, projections: int, threshold: float, enough: float,
    block_rows: int, query_rows: int,
) -> DataFrame:
    """(query_id, vec_id, score): the nearest found in each block, for vectors of one length."""
    blocks = max(1, -(-total // block_rows))
    lines = directions(dim + 1, projections)
    # A difference of two typical vectors, along one direction.
    typical = np.sqrt(2 * bound / (dim + 1))
    # By the row's place too, so that equal rows spread like others.
    in_block = F.pmod(F.xxhash64("id", "x", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")

    def build(block):
        x, ids = matrix(block["x"], dim), block["id"]
        p = (lifted(x, bound) @ lines.T).T
        order = np.argsort(p, axis=1, kind="stable").astype(np.int32)
        return pa.table({
            "block": pa.array([block["block"][0].as_py()], pa.int32()), "ids": pa.array([ids.to_numpy()], pa.list_(pa.int64())),
            "vectors": pa.array([x.ravel()], pa.list_(pa.float64())), "lines": pa.array([np.take_along_axis(p, order, 1).ravel()], pa.list_(pa.float64())),
            "places": pa.array([order.ravel()], pa.list_(pa.int32())),
        })

    kept = "block int, ids array<long>, vectors array<double>, lines array<double>, places array<int>"
    index = stored(whole.withColumn("block", in_block).groupBy("block").applyInArrow(build, kept), "index")
    asked = stored(whole.filter(is_query).groupBy("id").agg(F.min("x").alias("x")), "queries")
    groups = max(1, -(-asked.count() // query_rows))
    sides = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("part"), "id", "x"
    )

    def search(key, left, right):
        if right.num_rows == 0 or left.num_rows == 0:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids = right["ids"].combine_chunks().flatten().to_numpy()
        n = len(ids)
        x = right["vectors"].combine_chunks().flatten().to_numpy().reshape(n, dim)
        lift = 4 * np.sqrt(bound) * np.arange(projections)  # projections reach from -sqrt(bound) to sqrt(bound)
        sorted_ = (right["lines"].combine_chunks().flatten().to_numpy().reshape(projections, n) + lift[:, None]).ravel()
        order = right["places"].combine_chunks().flatten().to_numpy().astype(np.int64)
        out = []
        for me, q in zip(left["id"].to_numpy(), matrix(left["x"], dim)):
            at = lines[:, :dim] @ (q * np.sqrt(bound / (q @ q)))
            pick, score = verified(
                sorted_, order, at + lift, FIRST_WIDTH * typical, k + 1, threshold * projections, enough, lambda p: x[p] @ q
            )
            others = ids[pick] != me
            pick, score = pick[others], score[others]
            best = best_rows(score, ids[pick], k)
            out.append((np.full(len(best), me), ids[pick[best]], np.array([float(np.dot(x[p], q)) for p in pick[best]])))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (np.concatenate(c) for c in zip(*out)))))

    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return sides.groupBy("block", "part").cogroup(spread.groupBy("block", "part")).applyInArrow(search, "query_id long, vec_id long, score double")
