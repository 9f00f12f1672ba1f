"""Exact top-k search by inner product: a Voronoi k-nearest-neighbour join.

Vectors become integers, floor(scale * x). The largest inner product is the nearest point once every
candidate gets one more coordinate, sqrt(M - |x|^2) with M the largest squared norm: then
|q - x|^2 = |q|^2 + M - 2 q.x for a query with 0 there. In that space

1. pivots come from a bounded sample; each query and candidate belongs to its nearest pivot's cell;
2. summaries per cell (size, extent, the few candidates nearest the pivot) give every query cell a bound
   on the distance of its k-th neighbour and, per candidate cell, the least distance from the pivot
   that a candidate needs to matter;
3. candidates go only to the query cells that need them, split into chunks of bounded size, and each
   (query block, chunk) is solved by itself; a window over the survivors keeps the best k. Query cells that
   need most candidates anyway are solved together, as many as fill a query block, so that a candidate is
   copied once for them all.

Defined cases: rows with a null id, and vectors that are null or hold null or non-finite components, take
no part. Vectors of each length are searched by themselves: a product of unlike lengths is not defined. A
repeated query id asks once per length, with its smallest vector, and is ranked over all; rows that share the query's id are never its candidates; other repeated rows
each count. Other columns are not read. An empty table gives no rows. Products are 64-bit integers.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medloom.llm.common import prepare, stored

PIVOTS, SAMPLE, CHUNK_ROWS, QUERY_ROWS = 16, 2048, 16384, 2048


def matrix(column: pa.Array, dim: int, dtype=np.float64) -> np.ndarray:
    """An Arrow list column without nulls as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): rows whose vector has only finite components, as doubles."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter(
        F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~F.coalesce(bad, F.lit(True))
    )


def lengths(df: DataFrame, norm: Column) -> list[tuple[int, float, int]]:
    """Each vector length with its largest `norm` and its number of rows."""
    rows = df.groupBy(F.size("x").alias("dim")).agg(F.max(norm).alias("m"), F.count("*").alias("n")).orderBy("dim").collect()
    return [(r["dim"], float(r["m"]), r["n"]) for r in rows]


def pick_pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first points of the sample, starting from the first."""
    points = np.unique(points, axis=0)
    chosen, far = [0], np.full(len(points), np.inf)
    while len(chosen) < min(n, len(points)):
        far = np.minimum(far, np.linalg.norm(points - points[chosen[-1]], axis=1))
        chosen.append(int(far.argmax()))
    return points[chosen]


def lifted(x: np.ndarray, bound: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(0, bound - (x * x).sum(axis=1)))]


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding",
    pivots: int = PIVOTS, sample: int = SAMPLE, chunk_rows: int = CHUNK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Each query's k largest integer inner products: query_id, rank, vec_id, score.

    `is_query` is a condition on the column `id`. `sample` bounds the rows the pivots are chosen from.
    """
    spark = vectors.sparkSession
    prepare(spark)
    whole = usable(vectors, id_col, vec_col).withColumn("x", F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long")))
    squared = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    found = [
        _of_length(whole.filter(F.size("x") == dim), is_query, dim, bound, k, pivots, sample, chunk_rows, query_rows) for dim, bound, _ in lengths(whole, squared)
    ]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_length(
    whole: DataFrame, is_query: Column, dim: int, bound: float, k: int, pivots: int, sample: int, chunk_rows: int, query_rows: int
) -> DataFrame:
    """(query_id, vec_id, score): the best of each chunk, for vectors of one length."""
    few = whole.orderBy(F.xxhash64("id"), "id").limit(sample).select("x").toArrow()
    points = pick_pivots(lifted(matrix(few["x"], dim), bound), pivots)
    n = len(points)

    def to_cells(lift):
        def run(batches):
            for b in batches:
                x = matrix(b["x"], dim)
                d = np.linalg.norm((lifted(x, bound) if lift else np.c_[x, np.zeros(len(x))])[:, None, :] - points[None], axis=2)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b["id"], b["x"], pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], ["id", "x", "cell", "dist"]
                )
        return run

    placed = "id long, x array<long>, cell int, dist double"
    data = stored(whole.mapInArrow(to_cells(True), placed), "candidates")
    asked = whole.filter(is_query).groupBy("id").agg(F.min("x").alias("x"))
    queries = stored(asked.mapInArrow(to_cells(False), placed), "queries")

    # Summaries, a few rows per pivot.
    own = data.groupBy("id").count().agg(F.max("count")).first()[0] or 0  # rows a query must leave out at most
    size, extent = np.zeros(n), np.zeros(n)
    for r in data.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("d")).collect():
        size[r["cell"]], extent[r["cell"]] = r["n"], r["d"]
    near = Window.partitionBy("cell").orderBy("dist")
    closest = data.select("cell", "dist", F.row_number().over(near).alias("r")).filter(F.col("r") <= min(k + own, chunk_rows)).collect()
    reach, asking = np.full(n, -1.0), np.zeros(n, dtype=np.int64)
    for r in queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("d")).collect():
        asking[r["cell"]], reach[r["cell"]] = r["n"], r["d"]
    between = np.linalg.norm(points[:, None] - points[None], axis=2)
    least = np.full((n, n), np.inf)  # least[i, j]: what a candidate of cell j must be away from its pivot to matter to query cell i
    slack = 1e-6 * (1 + math.sqrt(bound) + extent.max(initial=0) + reach.max(initial=0))  # rounding of distances
    for i in np.flatnonzero(asking):
        upper = sorted(reach[i] + between[i, r["cell"]] + r["dist"] for r in closest)
        theta = upper[k + own - 1] if len(upper) >= k + own else np.inf
        least[i] = between[i] - reach[i] - theta - slack
    # Query cells whose bounds leave out less than half of the candidates share a group, while a block holds their queries.
    group, at, room = np.arange(n), -1, 0
    for i in np.flatnonzero(asking):
        if 2 * sum(size[j] for j in range(n) if least[i, j] <= extent[j]) <= size.sum():
            continue
        if at < 0 or room < asking[i]:
            at = i
        else:
            least[at], asking[at], asking[i] = np.minimum(least[at], least[i]), asking[at] + asking[i], 0
        group[i], room = at, query_rows - asking[at]
    needed = [int(sum(size[j] for j in range(n) if least[i, j] <= extent[j])) for i in range(n)]
    chunks = np.array([max(1, -(-needed[i] // chunk_rows)) for i in range(n)])
    blocks = np.maximum(1, -(-asking // query_rows))

    def replicate(batches):
        for b in batches:
            cell, dist, ids = (b[c].to_numpy() for c in ("cell", "dist", "id"))
            for i in np.flatnonzero(asking):
                rows = np.flatnonzero(dist >= least[i][cell])
                if len(rows) == 0:
                    continue
                part = b.take(pa.array(rows))
                spread = ((ids[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % chunks[i]
                for q in range(blocks[i]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), v, np.int32)) for v in (i, q)] + [pa.array(spread.astype(np.int32)), part["id"], part["x"]],
                        ["cell", "block", "chunk", "id", "x"],
                    )

    keyed = "cell int, block int, chunk int, id long, x array<long>"
    split = F.element_at(F.array(*[F.lit(int(c)) for c in chunks]), F.col("cell") + 1)
    per = F.element_at(F.array(*[F.lit(int(c)) for c in blocks]), F.col("cell") + 1)
    grouped = queries.withColumn("cell", F.element_at(F.array(*[F.lit(int(g)) for g in group]), F.col("cell") + 1))
    sides = grouped.select(
        "cell", F.pmod(F.xxhash64("id"), per.cast("long")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), split - 1)).alias("chunk"), "id", "x"
    )

    def solve(key, left, right):
        q, x = matrix(left["x"], dim, np.int64), matrix(right["x"], dim, np.int64)
        if max(abs(q).max(initial=0), abs(x).max(initial=0)) < 1 << 22:  # all products are exact in doubles
            q, x = q.astype(np.float64), x.astype(np.float64)
        qid, ids = left["id"].to_numpy(), right["id"].to_numpy()
        out = []
        for at in range(0, len(qid), 128):
            scores = (q[at:at + 128] @ x.T).astype(np.int64)
            for me, row in zip(qid[at:at + 128], scores):
                others = np.flatnonzero(ids != me)
                best = others[best_rows(row[others], ids[others], k)]
                out.append((np.full(len(best), me), ids[best], row[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))

    return sides.groupBy("cell", "block", "chunk").cogroup(
        data.mapInArrow(replicate, keyed).groupBy("cell", "block", "chunk")
    ).applyInArrow(solve, "query_id long, vec_id long, score long")
