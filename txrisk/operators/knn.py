"""Exact k-nearest-neighbour self-join (M6) without a cross join.

Euclidean distance in double; ties broken by neighbour id; a row is never
its own neighbour. Plan (pivot partitioning with triangle-inequality pruning,
after the kNN-join designs of Lu et al., VLDB 2012):

  1. P pivots = the P rows with the smallest hash draw. P grows with the square
     root of the rows, between 32 and ``MAX_PIVOTS`` (or is given), so the broadcast
     pivot matrix is bounded by MAX_PIVOTS x dim. The assignment is stored once.
  2. Every row joins the cell of its nearest pivot; per cell: count, radius.
  3. For a query q: the k-th neighbour distance is at most the smallest
     d(q, p_c) + r_c whose cumulated cell count reaches k (+1 for q itself);
     only cells with d(q, p_c) - r_c within that bound can hold neighbours.
  4. Near cells are gathered into blocks of at most ``block_size`` rows, larger cells cut
     into several. A query carries the numbers of the blocks that hold one of its cells
     and is copied once per such block, not once per cell.
  5. Each (member block, query block) pair is one bounded cogroup; its numpy kernel
     shortlists by a matrix product, measures the shortlist exactly and emits only the k
     best members per query.
  6. The per-block winners are merged per query (top-k window limit).

No task holds more than two blocks, and no pair row is ever materialised. A vector is
copied at most 2 * rows / ``block_size`` times, where nothing can be pruned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.draws import draw
from txrisk.session import reliable_checkpoint, ship_package

MAX_PIVOTS = 4096
BLOCK_BYTES = 16 << 20      # vectors of one block
MAX_BLOCK_ROWS = 32768
MIN_BLOCK_ROWS = 1024
SLICE = 2_000_000           # numbers of a distance matrix held at once
FOLD = 32                   # numbers of a row told apart by their minimum only
PAIRS_DDL = "id long, nn_id long, distance double"


def _stack(series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series])


def _dist_to(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty((points.shape[0], centers.shape[0]))
    for j in range(centers.shape[0]):
        diff = points - centers[j]
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _slices(n: int, width: int):
    """Row ranges of an (n, width) matrix that stay below ``SLICE`` numbers."""
    step = max(1, SLICE // max(1, width))
    return [slice(i, min(n, i + step)) for i in range(0, n, step)]


def _block_rows(n_rows: int, dim: int) -> int:
    """Rows of a block: bounded in bytes, and several blocks even where few rows would fit one."""
    return max(1, min(BLOCK_BYTES // (8 * max(1, dim)), MAX_BLOCK_ROWS, max(MIN_BLOCK_ROWS, n_rows // 8)))


def _units(cells: list[tuple[int, int, float]], pivots: np.ndarray, block_size: int) -> list[tuple[list[int], int, int]]:
    """(positions in ``cells``, first block, blocks): near cells together up to ``block_size``
    rows in one block, a larger cell alone in several."""
    size = np.array([c[1] for c in cells])
    at = pivots[[c[0] for c in cells]]
    open_, out, block = np.ones(len(cells), bool), [], 0
    for i in range(len(cells)):
        if not open_[i]:
            continue
        if size[i] >= block_size:
            take, n = [i], int(-(-size[i] // block_size))
        else:
            free = np.nonzero(open_ & (size < block_size))[0]
            diff = at[free] - at[i]
            free = free[np.argsort(np.einsum("ij,ij->i", diff, diff), kind="stable")]
            free = np.concatenate(([i], free[free != i]))
            take, n = free[:max(1, int((np.cumsum(size[free]) <= block_size).sum()))].tolist(), 1
        open_[take] = False
        out.append((take, block, n))
        block += n
    return out


def knn(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec",
        group_col: str | None = None, n_pivots: int | None = None, block_size: int | None = None) -> DataFrame:
    """(id, nn_rank, nn_id, distance): the k nearest other rows of the same group."""
    spark = df.sparkSession
    ship_package(spark)
    g = F.col(group_col).cast("string") if group_col else F.lit("all")
    data = df.select(F.col(id_col).cast("long").alias("id"), g.alias("grp"),
                     F.col(vec_col).cast("array<double>").alias("vec"))

    n_rows = None
    if n_pivots is None or block_size is None:
        n_rows = data.count()
    if n_pivots is None:
        n_pivots = min(MAX_PIVOTS, max(32, int(n_rows ** 0.5)))
    piv_rows = data.orderBy(draw(F.col("id"), "pivot"), "id").limit(int(n_pivots)).select("vec").collect()
    pivots = _stack([r["vec"] for r in piv_rows])
    if pivots.shape[0] == 0:
        return spark.createDataFrame([], "id long, nn_rank int, nn_id long, distance double")
    bsz = int(block_size or _block_rows(n_rows, pivots.shape[1]))
    bc = spark.sparkContext.broadcast(pivots)

    def assign(batches):
        pv = bc.value
        for pdf in batches:
            x = _stack(pdf["vec"])
            cell, dp = np.zeros(len(pdf), "int32"), np.zeros(len(pdf))
            for s in _slices(len(pdf), pv.shape[0]):
                d = _dist_to(x[s], pv)
                cell[s] = d.argmin(axis=1)
                dp[s] = d[np.arange(len(d)), cell[s]]
            yield pd.DataFrame({"id": pdf["id"], "grp": pdf["grp"], "vec": pdf["vec"], "cell": cell, "dp": dp})

    assigned = reliable_checkpoint(
        data.mapInPandas(assign, "id long, grp string, vec array<double>, cell int, dp double"))
    # Per (group, cell) statistics: at most groups x P rows.
    stats_rows = assigned.groupBy("grp", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("dp").alias("r")).orderBy("grp", "cell").collect()
    stats: dict[str, list[tuple[int, int, float]]] = {}
    for r in stats_rows:
        stats.setdefault(r["grp"], []).append((int(r["cell"]), int(r["n"]), float(r["r"])))
    units = {grp: _units(cells, pivots, bsz) for grp, cells in stats.items()}
    bstats = spark.sparkContext.broadcast((stats, units))
    need = int(k) + 1

    def candidates(batches):
        """Every row with the blocks that may hold its neighbours."""
        pv, (st, un) = bc.value, bstats.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = _stack(pdf["vec"])
            grp = pdf["grp"].to_numpy()
            asks = np.empty(len(pdf), object)
            for g in np.unique(grp):
                cells = st[g]
                rows = np.nonzero(grp == g)[0]
                cid = np.array([c[0] for c in cells])
                cnt = np.array([c[1] for c in cells])
                rad = np.array([c[2] for c in cells])
                by_unit = np.concatenate([u[0] for u in un[g]])
                starts = np.cumsum([0] + [len(u[0]) for u in un[g]])[:-1]
                times = np.array([u[2] for u in un[g]])
                for s in _slices(len(rows), len(cid)):
                    dq = _dist_to(x[rows[s]], pv[cid])              # (n, C)
                    ub = dq + rad                                   # every cell member is within ub
                    order = np.argsort(ub, axis=1, kind="stable")
                    cum = np.cumsum(cnt[order], axis=1)
                    pos = np.minimum((cum < need).sum(axis=1), len(cid) - 1)
                    line = np.arange(len(dq))
                    theta = ub[line, order[line, pos]]
                    keep = (dq - rad) <= (theta + 1e-9 * (1.0 + theta))[:, None]
                    blocks = np.repeat(np.logical_or.reduceat(keep[:, by_unit], starts, axis=1), times, axis=1)
                    for i, wanted in zip(rows[s], blocks):
                        asks[i] = np.nonzero(wanted)[0].astype("int32")
            yield pd.DataFrame({"id": pdf["id"], "grp": pdf["grp"], "vec": pdf["vec"], "cell": pdf["cell"], "asks": asks})

    # at most groups x P rows: a bounded broadcast
    laid = spark.createDataFrame(
        [(grp, cells[i][0], first, n) for grp, cells in stats.items() for take, first, n in units[grp] for i in take],
        "grp string, cell int, first int, n int")
    rows = reliable_checkpoint(
        assigned.mapInPandas(candidates, "id long, grp string, vec array<double>, cell int, asks array<int>")
        .join(F.broadcast(laid), ["grp", "cell"])
        .select("id", "grp", "vec", "asks",
                (F.col("first") + F.pmod(F.xxhash64("id"), F.col("n"))).cast("int").alias("blk")))
    qside = rows.select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), F.col("grp").alias("grp"),
                        F.col("blk").alias("qb"), F.explode("asks").alias("mb"))
    # the query blocks that ask for a block: (rows / block_size)^2 numbers at most
    asked = (qside.select("grp", "mb", "qb").distinct()
             .groupBy("grp", "mb").agg(F.collect_list("qb").alias("qbs")))
    mside = rows.select("id", "vec", "grp", F.col("blk").alias("mb")).join(asked, ["grp", "mb"]).select(
        "id", "vec", F.col("grp").alias("grp"), "mb", F.explode("qbs").alias("qb"))
    keys = ["grp", "mb", "qb"]
    part = qside.groupBy(*keys).cogroup(mside.groupBy(*keys)).applyInPandas(nearest_in_blocks(k), PAIRS_DDL)
    return merge_nearest(part, k)


def _kth_at_most(d2: np.ndarray, k: int) -> np.ndarray:
    """A bound of every row's ``k``-th smallest number, no smaller than it: that of the minima of
    ``FOLD`` numbers each, which are numbers of the row themselves. Few rows are taken as they stand."""
    n, wide = d2.shape
    lots = wide // FOLD
    if lots >= 8 * k:
        least = d2[:, :lots * FOLD].reshape(n, FOLD, lots).min(axis=1)
        return np.partition(least, k - 1, axis=1)[:, k - 1]
    return np.partition(d2, k - 1, axis=1)[:, k - 1]


def nearest(q: np.ndarray, qid: np.ndarray, m: np.ndarray, mid: np.ndarray, k: int):
    """(query ids, member ids, distances): the ``k`` nearest members of every query, by (distance, id);
    never a member of the query's own id. A matrix product gives distances up to a rounding
    bound; those within it of the k-th are measured exactly."""
    dim = m.shape[1]
    kq = min(int(k), len(m))
    q2, m2 = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", m, m)
    most = m2[np.isfinite(m2)].max(initial=0.0)
    own = np.isin(qid, mid)
    finite = bool(np.isfinite(q2).all() and np.isfinite(m2).all())
    q_2 = -2.0 * q
    rid, rnn, rd = [], [], []
    for s in _slices(len(q), len(m)):
        d2 = q_2[s] @ m.T                                          # less q2, which is one number for a query
        d2 += m2
        if not finite:
            d2[np.isnan(d2)] = np.inf
        if own[s].any():
            d2[mid == qid[s, None]] = np.inf                       # never itself
        near = _kth_at_most(d2, kq)
        slack = 8e-16 * (dim + 8) * (q2[s] + most)
        r, c = np.nonzero(d2 <= (near + slack)[:, None])
        r += s.start
        dist = np.empty(len(r))
        piece = max(1, 2 * SLICE // max(1, dim))
        for i in range(0, len(r), piece):
            diff = q[r[i:i + piece]] - m[c[i:i + piece]]
            dist[i:i + piece] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        ok = np.isfinite(dist) & (mid[c] != qid[r])
        r, c, dist = r[ok], c[ok], dist[ok]
        order = np.lexsort((mid[c], dist, r))                        # by (distance, id)
        r, c, dist = r[order], c[order], dist[order]
        first = np.arange(len(r)) - np.searchsorted(r, r) < kq
        rid.append(qid[r[first]])
        rnn.append(mid[c[first]])
        rd.append(dist[first])
    return np.concatenate(rid), np.concatenate(rnn), np.concatenate(rd)


def nearest_in_blocks(k: int):
    """Kernel of a block pair: the ``k`` nearest members of every query."""
    kk = int(k)

    def topk(qpdf: pd.DataFrame, mpdf: pd.DataFrame) -> pd.DataFrame:
        rid, rnn, rd = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
        if len(qpdf) and len(mpdf):
            rid, rnn, rd = nearest(_stack(qpdf["qvec"]), qpdf["qid"].to_numpy(dtype=np.int64),
                                   _stack(mpdf["vec"]), mpdf["id"].to_numpy(dtype=np.int64), kk)
        return pd.DataFrame({"id": rid, "nn_id": rnn, "distance": rd})

    return topk


def merge_nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of the blocks' winners, by (distance, id)."""
    w = Window.partitionBy("id").orderBy("distance", "nn_id")
    return pairs.withColumn("nn_rank", F.row_number().over(w)).filter(F.col("nn_rank") <= int(k)) \
        .select("id", "nn_rank", "nn_id", "distance")
