"""Approximate k-nearest neighbours (M6 at scale): a locality-sensitive hash index.

The exact join prunes by cells; where vectors have no structure it prunes nothing and
its work grows with the square of the rows. The index bounds the work instead:

  1. Every row gets a bucket in each of ``tables`` tables: the signs of ``bits`` random
     projections of the vector about the mean (random hyperplanes). ``bits`` follows the
     number of rows, so that a bucket holds about ``bucket_rows`` rows at any size.
  2. Rows meet in their buckets, and in the ``probes`` neighbouring buckets whose signs
     are the least certain for the query (the smallest projections). Buckets that share
     their leading signs form a stretch of at most ``STRETCH`` buckets. A vector is copied
     once per table as a member, into the stretch of its bucket, and once per table and
     stretch as a query, with the numbers of the buckets it asks there.
  3. A stretch of any size is cut into member blocks and query blocks; one bounded
     cogroup per pair of blocks measures true distances bucket by bucket and returns the
     k best of each query, which are merged per query. A pair found in several tables
     counts once.

Every row is indexed and every row is a query; neighbours found are exact in distance,
some may be missed. ``recall`` measures how many on a fixed query set (ids divisible by
100) against all rows, by blocks, without trusting either mode.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.draws import SEED
from txrisk.operators.knn import PAIRS_DDL, _stack, merge_nearest, nearest, nearest_in_blocks
from txrisk.session import reliable_checkpoint, ship_package

TABLES = 16
PROBES = 6
BUCKET_ROWS = 256
MAX_BITS = 30
EVERY = 100
STRETCH_BITS = 6
STRETCH = 1 << STRETCH_BITS      # buckets that meet in one cogroup
STRETCH_ROWS = 16384             # rows of a block of a stretch
FEW_BLOCKS = 200_000             # stretches whose numbers of blocks are broadcast


def signature_bits(n_rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return int(min(MAX_BITS, max(1, np.ceil(np.log2(max(2, n_rows) / bucket_rows)))))


def signatures(x: np.ndarray, planes: np.ndarray, probes: int) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket numbers: own bucket first, then those reached by
    turning over the least certain signs (the smallest one, the next one, ...)."""
    tables, bits, _ = planes.shape
    proj = np.einsum("nd,tbd->ntb", x, planes)
    weight = np.int64(1) << np.arange(bits, dtype=np.int64)
    own = ((proj >= 0) * weight).sum(axis=2)
    out = [own]
    order = np.argsort(np.abs(proj), axis=2, kind="stable")
    for i in range(min(probes, bits)):
        out.append(own ^ weight[order[:, :, i]])
    return np.stack(out, axis=2)


def lsh_knn(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec", group_col: str | None = None,
            tables: int = TABLES, probes: int = PROBES, bucket_rows: int = BUCKET_ROWS, block_size: int = STRETCH_ROWS,
            seed: int = SEED) -> DataFrame:
    """(id, nn_rank, nn_id, distance): up to ``k`` near rows of the same group per row."""
    spark = df.sparkSession
    ship_package(spark)
    g = F.col(group_col).cast("string") if group_col else F.lit("all")
    data = df.select(F.col(id_col).cast("long").alias("id"), g.alias("grp"),
                     F.col(vec_col).cast("array<double>").alias("vec"))
    n, dim = data.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return spark.createDataFrame([], "id long, nn_rank int, nn_id long, distance double")
    centre = data.select(F.posexplode("vec").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m")).collect()  # dim rows
    mean = np.zeros(dim)
    for r in centre:
        mean[r["i"]] = r["m"]
    bits = signature_bits(n, bucket_rows)
    planes = np.random.default_rng(seed).standard_normal((tables, bits, dim))
    bc = spark.sparkContext.broadcast((planes, mean))       # tables x bits x dim numbers

    def sign(batches):
        pl, mu = bc.value
        for pdf in batches:
            if len(pdf):
                sig = signatures(_stack(pdf["vec"]) - mu, pl, probes)
                yield pd.DataFrame({"id": pdf["id"], "grp": pdf["grp"], "vec": pdf["vec"],
                                    "sig": list(sig.reshape(len(pdf), -1))})

    signed = reliable_checkpoint(data.mapInPandas(sign, "id long, grp string, vec array<double>, sig array<long>"))
    ways = 1 + min(probes, bits)
    low = min(STRETCH_BITS, bits)
    at = F.posexplode("sig").alias("way", "bucket")
    # one copy of a row per table and stretch it asks, with the asked buckets, its own first where it is at home
    stretch = lambda b: F.shiftright(b, low)
    per_table = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.slice("sig", t * ways + 1, ways))
    queries = (signed.select("id", "grp", "vec", F.posexplode(per_table).alias("tab", "asked"))
               .select("*", F.explode(F.array_distinct(F.transform("asked", stretch))).alias("part"))
               .select("id", "grp", "vec", "tab", "part", F.filter("asked", lambda b: stretch(b) == F.col("part")).alias("asked")))
    members = signed.select("id", "grp", "vec", at).where(F.col("way") % ways == 0).select(
        "id", "grp", "vec", F.floor(F.col("way") / ways).cast("int").alias("tab"), stretch(F.col("bucket")).alias("part"), "bucket")
    # stretch sizes, map-side combined: blocks of a stretch on either side
    key = ["grp", "tab", "part"]
    sizes = members.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias("nmb"))
    asked = queries.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias("nqb"))
    blocks = reliable_checkpoint(sizes.join(asked, key).where("nmb > 1 or nqb > 1"))
    cut = F.broadcast(blocks) if blocks.count() <= FEW_BLOCKS else blocks
    of = lambda m: F.coalesce(F.col(m), F.lit(1))
    every = lambda m: F.explode(F.sequence(F.lit(0), of(m) - 1))
    mine = lambda m: F.pmod(F.xxhash64("id"), of(m)).cast("int")
    same = [F.col(c).alias(c) for c in key]
    qside = queries.join(cut, key, "left").select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), "asked", *same,
                                                  mine("nqb").alias("qb"), every("nmb").alias("mb"))
    mside = members.join(cut, key, "left").select("id", "vec", "bucket", *same, mine("nmb").alias("mb"), every("nqb").alias("qb"))
    key = [*key, "mb", "qb"]
    pairs = qside.groupBy(*key).cogroup(mside.groupBy(*key)).applyInPandas(nearest_in_buckets(k), PAIRS_DDL)
    # one exchange on the query; a pair counts once, the tables agree on its distance
    return merge_nearest(pairs.repartition("id").groupBy("id", "nn_id").agg(F.min("distance").alias("distance")), k)


def nearest_in_buckets(k: int):
    """Kernel of a block pair of a stretch: the ``k`` nearest of the members of the buckets a query asks."""
    def topk(qpdf: pd.DataFrame, mpdf: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0))]
        if len(qpdf) and len(mpdf):
            m, mid = _stack(mpdf["vec"]), mpdf["id"].to_numpy(dtype=np.int64)
            q, qid = _stack(qpdf["qvec"]), qpdf["qid"].to_numpy(dtype=np.int64)
            asked = [np.asarray(a, dtype=np.int64) for a in qpdf["asked"]]
            who, what = np.repeat(np.arange(len(q)), [len(a) for a in asked]), np.concatenate(asked)
            bucket = mpdf["bucket"].to_numpy(dtype=np.int64)
            by_m, by_q = np.argsort(bucket, kind="stable"), np.argsort(what, kind="stable")
            for b in np.unique(bucket):
                rows = by_m[slice(*np.searchsorted(bucket, [b, b + 1], sorter=by_m))]
                ask = who[by_q[slice(*np.searchsorted(what, [b, b + 1], sorter=by_q))]]
                if len(ask):
                    found.append(nearest(q[ask], qid[ask], m[rows], mid[rows], k))
        rid, rnn, rd = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((rnn, rd, rid))
        rid, rnn, rd = rid[order], rnn[order], rd[order]
        if len(rid):     # the best over the buckets of the stretch; each holds other members
            new = np.concatenate(([True], rid[1:] != rid[:-1]))
            first = np.maximum.accumulate(np.where(new, np.arange(len(rid)), 0))
            once = np.concatenate(([True], new[1:] | (rnn[1:] != rnn[:-1])))
            rank = np.cumsum(once)
            keep = once & (rank - rank[first] < k)
            rid, rnn, rd = rid[keep], rnn[keep], rd[keep]
        return pd.DataFrame({"id": rid, "nn_id": rnn, "distance": rd})

    return topk


def nearest_of_queries(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec", every: int = EVERY,
                       block_size: int = 1024) -> DataFrame:
    """Exact (id, nn_rank, nn_id, distance) of the rows whose id is divisible by ``every``, against all
    rows: blocks of queries against blocks of rows."""
    data = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    chosen = F.col("id") % every == 0
    n, q = data.agg(F.count(F.lit(1)), F.count_if(chosen)).first()
    nmb, nqb = max(1, -(-n // (16 * block_size))), max(1, -(-q // block_size))
    mine = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    qside = data.where(chosen).select(F.col("id").alias("qid"), F.col("vec").alias("qvec"), mine(nqb).alias("qb"),
                                      each(nmb).alias("mb"))
    mside = data.select("id", "vec", mine(nmb).alias("mb"), each(nqb).alias("qb"))
    pairs = qside.groupBy("mb", "qb").cogroup(mside.groupBy("mb", "qb")).applyInPandas(nearest_in_blocks(k), PAIRS_DDL)
    return merge_nearest(pairs, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (queries, neighbours, found, recall): how many of the exact neighbours were found. A row as
    near as the last exact one counts as found, whichever of equals it is."""
    reach = exact.groupBy("id").agg(F.max("distance").alias("reach"), F.count(F.lit(1)).alias("n"))
    hits = (found.join(reach, "id").where(F.col("distance") <= F.col("reach") * (1 + 1e-12))
            .groupBy("id").agg(F.count(F.lit(1)).alias("hit")))
    return (reach.join(hits, "id", "left").agg(F.count(F.lit(1)).alias("queries"), F.sum("n").alias("neighbours"),
                                               F.sum(F.coalesce("hit", F.lit(0))).alias("found"))
            .withColumn("recall", F.try_divide(F.col("found"), F.col("neighbours"))))
