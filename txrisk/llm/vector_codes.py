"""Product-quantised vector codes; assignment by norm-of-sum bounds.

Every part of every vector keeps its entry, an upper bound on the distance to it and a
lower bound on the distance to all other entries, each with the round in which it was
measured. All codebooks since the first are kept (at most rounds + 1 small tables), so a
bound taken in round ``s`` is carried to round ``t`` by the distance between the entry's
places in ``s`` and ``t`` themselves: the norm of the summed steps, which is never more
than the sum of the steps' norms that accumulated drifts would charge. Only where the
bounds do not settle the entry is the distance to it measured anew, and only where that
does not settle it either are all entries scanned.

Bounds only ever skip a scan whose outcome is certain; distances, sums and floors are
integers, so the codes are those of a full scan in every round. The vectors with their
bounds are written once a round below the shared checkpoint folder; the table before is
deleted once it is read no more. The driver sees ``PARTS * ENTRIES`` sums a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import written
from txrisk.llm.vectors import extent, fixed, integers, lists, matrix, usable
from txrisk.session import delete_path, shared_path

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
HEAVY_SHARE = 1000   # labels with more than one row in so many are broadcast: as many at most
NEVER = -1           # entry of a part that has none yet


def sq(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


def above(x: np.ndarray) -> np.ndarray:
    """Single precision, not less than ``x``."""
    return np.nextafter((x * (1 + 1e-12)).astype(np.float32), np.float32(np.inf))


def below(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - 1e-12)).astype(np.float32), np.float32(-np.inf))


def net_moves(history: np.ndarray) -> np.ndarray:
    """(round, part, entry): net displacement from that round's place to the present one."""
    return np.sqrt(sq((history[-1] - history).astype(np.float64))) * (1 + 1e-12)


def summed_drifts(history: np.ndarray) -> np.ndarray:
    """What accumulated drifts charge for the same (for comparison in tests)."""
    steps = np.sqrt(sq(np.diff(history, axis=0).astype(np.float64)))
    return np.concatenate([np.cumsum(steps[::-1], axis=0)[::-1], np.zeros_like(steps[:1])])


def greatest_other(moves: np.ndarray) -> np.ndarray:
    """(round, part, entry): the greatest move among all entries but this one."""
    out = np.zeros_like(moves)
    for j in range(moves.shape[2]):
        out[:, :, j] = np.delete(moves, j, axis=2).max(axis=2, initial=0.0)
    return out


class Assigned:
    """Entries and bounds of a batch: arrays (rows, parts)."""

    def __init__(self, code, upper, lower, upper_at, lower_at):
        self.code, self.upper, self.lower, self.upper_at, self.lower_at = code, upper, lower, upper_at, lower_at

    @classmethod
    def unset(cls, n: int, parts: int) -> Assigned:
        shape = (n, parts)
        return cls(np.full(shape, NEVER, np.int8), np.full(shape, np.inf, np.float32), np.zeros(shape, np.float32),
                   np.zeros(shape, np.int8), np.zeros(shape, np.int8))

    def advance(self, x: np.ndarray, history: np.ndarray) -> tuple[int, int]:
        """Nearest entries of the newest codebook for ``x`` (rows, parts, width); the numbers of
        distances to the own entry and of full scans."""
        now, book = len(history) - 1, history[-1]
        moves = net_moves(history)
        others = greatest_other(moves)
        part = np.arange(x.shape[1])
        has = self.code != NEVER
        code = np.where(has, self.code, 0)
        upper = self.upper + moves[self.upper_at, part, code]
        lower = self.lower - others[self.lower_at, part, code]
        unsettled = ~(has & (upper < lower))
        measured = scans = 0
        for p in part:
            rows = np.flatnonzero(unsettled[:, p])
            if not len(rows):
                continue
            mine = rows[has[rows, p]]
            measured += len(mine)
            own = above(np.sqrt(sq(x[mine, p] - book[p, code[mine, p]]).astype(np.float64)))
            self.upper[mine, p], self.upper_at[mine, p] = own, now
            rows = np.concatenate([mine[~(own < lower[mine, p])], rows[~has[rows, p]]])
            scans += len(rows)
            far = np.stack([sq(x[rows, p] - entry) for entry in book[p]], axis=1)
            best = far.argmin(axis=1)      # the first of equals
            self.code[rows, p] = best
            first = far[np.arange(len(rows)), best].astype(np.float64)
            second = np.full(len(rows), np.inf)
            if far.shape[1] > 1:
                second = np.partition(far, 1, axis=1)[:, 1].astype(np.float64)
            self.upper[rows, p], self.lower[rows, p] = above(np.sqrt(first)), below(np.sqrt(second))
            self.upper_at[rows, p] = self.lower_at[rows, p] = now
        return measured, scans


def state_ddl(vectors: DataFrame, most: int) -> str:
    kinds = dict(vectors.dtypes)
    return (f"vec_id {kinds['vec_id']}, label {kinds['label']}, x array<{'int' if most < 1 << 31 else 'long'}>, "
            "code array<tinyint>, was array<tinyint>, bounds array<float>, stamps array<tinyint>, moved boolean")


def split(batch: pa.RecordBatch, parts: int, width: int) -> np.ndarray:
    return matrix(batch["x"], parts * width).reshape(batch.num_rows, parts, width)


def resumed(batch: pa.RecordBatch, parts: int) -> Assigned:
    """The batch's entries and bounds; unset in the first round."""
    if "code" not in batch.schema.names:
        return Assigned.unset(batch.num_rows, parts)
    bounds, stamps = fixed(batch["bounds"], 2 * parts).copy(), fixed(batch["stamps"], 2 * parts).copy()
    return Assigned(fixed(batch["code"], parts).copy(), bounds[:, :parts], bounds[:, parts:],
                    stamps[:, :parts], stamps[:, parts:])


def assign(history: np.ndarray):
    """One round: the batch with its entries and bounds after the newest codebook."""
    parts, width = history.shape[1], history.shape[3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a = resumed(b, parts)
            was = a.code.copy()
            a.advance(split(b, parts, width), history)
            yield pa.RecordBatch.from_pydict({
                "vec_id": b["vec_id"], "label": b["label"], "x": b["x"], "code": lists(a.code, pa.int8()),
                "was": lists(was, pa.int8()), "bounds": lists(np.hstack([a.upper, a.lower]), pa.float32()),
                "stamps": lists(np.hstack([a.upper_at, a.lower_at]), pa.int8()),
                "moved": pa.array((a.code != was).any(axis=1))})
    return run


def shifts(parts: int, entries: int, width: int):
    """A task's change of the entries' counts and sums: at most parts * entries rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x, code, was = split(b, parts, width), fixed(b["code"], parts), fixed(b["was"], parts)
            for p in range(parts):
                new = np.flatnonzero(code[:, p] != was[:, p])
                np.add.at(n[p], code[new, p], 1)
                np.add.at(total[p], code[new, p], x[new, p])
                old = new[was[new, p] != NEVER]
                np.add.at(n[p], was[old, p], -1)
                np.add.at(total[p], was[old, p], -x[old, p])
        part, entry = np.nonzero(n.astype(bool) | total.any(axis=2))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()),
            "n": pa.array(n[part, entry], pa.int64()), "total": lists(total[part, entry], pa.int64())})
    return run


def finish(history: np.ndarray):
    """Last assignment: the code and the squared distances to its entries."""
    parts, width = history.shape[1], history.shape[3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, a = split(b, parts, width), resumed(b, parts)
            a.advance(x, history)
            error = sq(x - history[-1][np.arange(parts), a.code]).sum(axis=1)
            yield pa.RecordBatch.from_pydict({
                "vec_id": b["vec_id"], "label": b["label"],
                "code": pa.array(["".join(f"{c:02x}" for c in row) for row in a.code.tolist()], pa.string()),
                "error": pa.array(error, pa.int64())})
    return run


def _stored(spark: SparkSession, df: DataFrame) -> tuple[DataFrame, str]:
    path = shared_path(spark, "llm", "vector_codes", unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def with_label_error(spark: SparkSession, coded: DataFrame) -> DataFrame:
    """``label_error`` of every row. A label with more than 1 in ``HEAVY_SHARE`` of the rows gets it
    by a broadcast of the (at most ``HEAVY_SHARE``) frequent labels, the others by an ordinary join."""
    totals = written(spark, coded.groupBy("label").agg(F.sum("error").alias("label_error"),
                                                       F.count(F.lit(1)).alias("n")), "label_totals")
    n = totals.agg(F.sum("n")).first()[0] or 0
    heavy = totals.where(F.col("n") * HEAVY_SHARE > n).select(F.col("label").alias("name"), "label_error")
    rare = totals.where(F.col("n") * HEAVY_SHARE <= n).select(F.col("label").alias("name"), "label_error")
    same = F.col("label").eqNullSafe(F.col("name"))
    cols = [*coded.columns, "label_error"]
    return (coded.join(F.broadcast(heavy), same).select(*cols)
            .unionByName(coded.join(F.broadcast(heavy), same, "left_anti").join(rare, same).select(*cols)))


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of every usable vector, and all codebooks in turn
    (round, part, entry, component).

    Vectors that are null or hold null or non-finite components are dropped. The first entries are the
    parts of the vectors with the smallest ids (null last, then by components); fewer vectors give fewer
    entries. Repeated rows count as often as they stand. Vectors shorter than the widest, or of a length
    that the parts do not divide, count as filled up with zeros. Rows without a label form a label of their own.
    An empty table gives no rows and codebooks without entries; other columns are not read. Squared distances
    that could pass 63 bits end in a ValueError."""
    spark = vectors.sparkSession
    _, longest, most = extent(vectors, scale)
    width = max(1, -(-longest // parts))
    if 4 * most * most * width * parts >= 1 << 62:
        raise ValueError("squared distances would pass 63 bits")
    rows = vectors.where(usable()).select("vec_id", "label", integers(scale, most).alias("x"))
    first = [r["x"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()]
    book = np.zeros((len(first), parts * width), np.int64)
    for i, x in enumerate(first):
        book[i, :len(x)] = x
    history = book.reshape(len(first), parts, width).swapaxes(0, 1)[None]
    k = len(first)
    n, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
    state, path, ddl = rows, None, state_ddl(vectors, most)
    for _ in range(rounds if k else 0):
        state, new = _stored(spark, state.mapInArrow(assign(history), ddl))
        if path:
            delete_path(spark, path)
        path = new
        sums = (state.where("moved").select("x", "code", "was")
                .mapInArrow(shifts(parts, k, width), "part int, entry int, n long, total array<long>")
                .groupBy("part", "entry")
                .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")))
        for r in sums.collect():       # at most parts * entries rows
            n[r["part"], r["entry"]] += r["n"]
            total[r["part"], r["entry"]] += np.array(r["total"], np.int64)
        used = n > 0
        entry = np.where(used[..., None], total // np.maximum(n, 1)[..., None], history[-1])
        history = np.concatenate([history, entry[None]])
    kinds = dict(vectors.dtypes)
    coded = written(spark, state.mapInArrow(
        finish(history), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "vector_codes")
    if path:
        delete_path(spark, path)
    return with_label_error(spark, coded), history


def codebook_hash(book: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def coded_rows(vectors: DataFrame) -> DataFrame:
    """The rows of ``vector_codes`` with the hash of the last codebook."""
    coded, history = vector_codes(vectors)
    return coded.select("vec_id", "code", "error", "label_error",
                        F.lit(codebook_hash(history[-1])).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL of ``coded_rows``: a full scan in every round, one step after the other."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT r, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS y
  FROM v, range({parts}) AS t(p)
),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, y AS c FROM s WHERE r <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, p, arg_min(e, d * {entries} + e) AS e, min(d) AS d
  FROM (SELECT s.r, s.p, b.e,
               list_sum(list_transform(list_zip(s.y, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM s JOIN b{i} b ON s.p = b.p)
  GROUP BY r, p
)""")
        if i < rounds:
            steps.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM b{i} b LEFT JOIN (
    SELECT p, e, list((t - ((t % m) + m) % m) // m ORDER BY j) AS c FROM (
      SELECT s.p, a.e, j, sum(s.y[j + 1])::BIGINT AS t, count(*)::BIGINT AS m
      FROM s JOIN a{i} a ON s.r = a.r AND s.p = a.p, range(len(s.y)) AS u(j) GROUP BY s.p, a.e, j)
    GROUP BY p, e) n ON b.p = n.p AND b.e = n.e
)""")
    last = rounds
    return f"""WITH {','.join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{last} GROUP BY r
),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{last})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN v USING (r), book"""
