"""Exact top-k inner-product search by the threshold algorithm.

Every block of candidates has one list per dimension, sorted by that component. A query
walks its lists from the end that its component's sign makes the better one. All rows
met at a depth are scored in full (random access); a row not met yet has at each
dimension at most the list's value at that depth, so no unseen row can score above the
sum of the query's products with those values. The walk ends when that bound is below
the k-th best score, so a tie is never lost.

Queries and candidates meet in tiles: ``QUERIES`` queries against ``ROWS`` candidates at
most, spread by row number, so repeated vectors or ids crowd no tile. A tile goes through its
candidates block by block and carries the k-th best score on: a later block's walk ends at once
where its first bound is below it. It returns k rows a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.llm.common import written
from txrisk.llm.vectors import extent, integers, matrix, usable

SCALE = 256
EVERY = 50           # rows whose id is divisible by it are the queries
K = 5
QUERIES = 4096       # queries of a tile
ROWS = 1 << 18       # candidates of a tile
LEAST_ROWS = 1 << 11  # from which on rows are dealt to further tiles
BLOCK = 8192         # candidates with common sorted lists
FIRST_DEPTH = 64
FOUND_DDL = "query_row long, query_id long, row long, vec_id long, score long"


class Lists:
    """Sorted lists of a block: row ``d`` of ``order`` has the rows by component ``d``, greatest first."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.ascontiguousarray(np.argsort(-x, axis=0, kind="stable").T)
        self.value = np.take_along_axis(x.T, self.order, axis=1)

    def search(self, q: np.ndarray, k: int, floor: float, skip: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows (in row order among ties) and scores of the k best rows but ``skip``, as far as
        they can reach ``floor``, and the number of rows scored."""
        n = len(self.x)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        if not len(up) + len(down):
            up = np.arange(len(q))       # a zero query: every score is zero, any list will do
        seen = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, self.x.dtype)
        done, depth, scored, kth = 0, FIRST_DEPTH, 0, floor
        best = q[up] @ self.value[up, 0] + q[down] @ self.value[down, n - 1]
        while best >= kth and done < n:
            depth = min(depth, n)
            met = np.zeros(n, bool)
            met[self.order[up, done:depth]] = True
            met[self.order[down, n - depth:n - done]] = True
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            scored += len(fresh)
            got = self.x[fresh] @ q
            if skip is not None:
                got, fresh = got[fresh != skip], fresh[fresh != skip]
            hold = got >= kth
            rows, scores = np.concatenate([rows, fresh[hold]]), np.concatenate([scores, got[hold]])
            if len(rows) > k:
                top = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[top], scores[top]
            if len(rows) >= k:
                kth = max(kth, scores.min())
            best = q[up] @ self.value[up, depth - 1] + q[down] @ self.value[down, n - depth]
            done, depth = depth, depth * 2
            if seen.all():
                break
        return rows, scores, scored


def search_tile(width: int, kind: str, k: int, block: int):
    """Top k of a tile's candidates for each of its queries. ``kind``: a number type in which all
    inner products are exact."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        qs = matrix(queries["x"].combine_chunks(), width).astype(kind) if len(queries) else np.empty((0, width))
        q_row = queries["row"].to_numpy()
        row, missing = rows["row"].to_numpy(), rows["vec_id"].is_null().to_numpy()
        number = rows["vec_id"].fill_null(0).to_numpy()
        order = np.lexsort((row, number, missing))
        x = matrix(rows["x"].combine_chunks(), width).astype(kind) if len(rows) else np.empty((0, width))
        top: list[list[tuple]] = [[] for _ in qs]
        for at in range(0, len(order) if len(qs) else 0, block):
            mine = order[at:at + block]
            part, place = Lists(x[mine]), {r: i for i, r in enumerate(row[mine].tolist())}
            for i, q in enumerate(qs):
                floor = -top[i][k - 1][0] if len(top[i]) >= k else -np.inf
                got, scores, _ = part.search(q, k, floor, place.get(int(q_row[i])))
                # rows are in id order within a tile, so the position settles ties
                top[i] = sorted(top[i] + [(-s, at + int(g)) for g, s in zip(got, scores.tolist())])[:k]
        found = [(int(q_row[i]), -s, order[p]) for i, best in enumerate(top) for s, p in best]
        names = dict(zip(q_row.tolist(), queries["query_id"].to_pylist()))
        return pa.table({"query_row": pa.array([f[0] for f in found], pa.int64()),
                         "query_id": pa.array([names[f[0]] for f in found], pa.int64()),
                         "row": pa.array([int(row[f[2]]) for f in found], pa.int64()),
                         "vec_id": pa.array([None if missing[f[2]] else int(number[f[2]]) for f in found], pa.int64()),
                         "score": pa.array([int(f[1]) for f in found], pa.int64())})
    return run


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = K, scale: int = SCALE, queries: int = QUERIES,
          rows: int = ROWS, least_rows: int = LEAST_ROWS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best rows of every query row, by the inner product
    of floor(scale * x).

    Vectors that are null or hold null or non-finite components take no part; rows without an id
    are candidates (last among ties) but no queries. Repeated rows are rows of their own: a query does not
    find its own row, but finds its copies. Shorter vectors count as filled up with zeros. Ties go to the
    smaller id. Fewer candidates than ``k`` give fewer rows; an empty table gives none. Other columns
    are not read. Ids are integers. Products that could pass 63 bits end in a ValueError."""
    spark = vectors.sparkSession
    n, width, most = extent(vectors, scale)
    if most * most * max(width, 1) >= 1 << 62:
        raise ValueError("inner products would pass 63 bits")
    kind = "float64" if most * most * max(width, 1) < 1 << 52 else "int64"
    picked = F.col("vec_id") % EVERY == 0 if is_query is None else is_query
    x = written(spark, vectors.where(usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"), integers(scale, most).alias("x"), picked.alias("asks"),
        F.monotonically_increasing_id().alias("row")), "topk_vectors")
    asking = x.where(F.col("asks")).select("row", F.col("vec_id").alias("query_id"), "x")
    q_tiles = max(1, -(-asking.count() // queries))
    tasks = spark.sparkContext.defaultParallelism
    c_tiles = max(1, -(-n // rows), min(tasks, -(-n // least_rows)))
    deal = lambda tiles, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(tiles)).cast("int")
    every = lambda tiles: F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    left = asking.select("*", deal(q_tiles, 1).alias("q"), every(c_tiles).alias("c"))
    right = x.select("row", "vec_id", "x", deal(c_tiles, 2).alias("c"), every(q_tiles).alias("q"))
    found = (left.groupBy("q", "c").cogroup(right.groupBy("q", "c"))
             .applyInArrow(search_tile(width, kind, k, block), FOUND_DDL))
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
