"""Packing documents into token sequences by cutting-stock column generation.

A document's tokens are cut into full sequences of ``LENGTH`` and a remainder. The
histogram of remainders (in classes of ``GRAIN`` tokens, so at most 512 rows, whatever
the corpus) is the demand of a cutting-stock problem. Its linear program over patterns
is solved by column generation: a revised simplex master, priced by a knapsack
dynamic program over the capacity. Rounded-down patterns are laid out as sequences and
assigned to the documents by their rank in their class; where the program covers a class
more than once, the surplus items are left out of their sequences. What rounding leaves
over (at most the items of all patterns together, whatever the corpus) goes first-fit
decreasing. The documents of badly filled sequences, of a pattern or of first-fit, are
laid end to end and cut at every ``LENGTH`` tokens, and the last stretch at powers of
two, which need no padding.

Tokens are computed once and stored. Only the histogram reaches the driver; ranks are
salted and the recut's places are prefix sums over blocks of ranks, so one length may
hold any share of the documents and any share may be recut.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.llm.common import give_back, n_salts, rank_in_groups, text_of, written

LENGTH = 2048
GRAIN = 4
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CACHE_BYTES = 96 << 20   # memory of a task for pieces
PIECE_BYTES = 220        # of a piece besides its letters and ids
LINE = 1024              # new words tokenised at once
MAX_PIVOTS = 4_000   # what rounding does not cover is fitted in any case
GAP = 5e-4           # relative gap to a lower bound at which pricing ends
BLEND = 0.05         # share of the duals in the stabilised prices
GOOD_FILL = 0.985    # sequences filled less are recut
RECUT_BLOCK = 1000   # ranks summed in one task of the recut


# ---------------------------------------------------------------- tokens
class _Numbers(dict):
    """Numbers keys as they come; ``new`` lists those not yet looked up."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class PieceIds:
    """Ids of texts, the tokenizer run once per distinct piece. The tokenizer lower-cases,
    cuts a text into the pieces of ``PIECE`` and drops white space, so a text's ids are
    those of its pieces in order. A word with a character outside ASCII and Latin-1
    letters, or with one of the tokenizer's added tokens, is one piece as it stands."""

    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]"
                       r"|[^ \t-\ra-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
    LETTERS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+\Z")
    SPACE = re.compile(r"[ \t-\r]+")
    MARK = "|"  # one token, never part of a run of letters

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tok = Tokenizer.from_file(public_tokenizers.path(name))
        self.tok.model._resize_cache(0)    # a piece comes once
        self.own = self.tok.normalizer, self.tok.pre_tokenizer
        # pieces need no second normalising and cutting
        self.plain = normalizers.Sequence([]), pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        added = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([r"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]", *added]))
        self.mark = self.tok.encode(self.MARK, add_special_tokens=False).ids
        self.clear()

    def _use(self, parts: tuple) -> None:
        self.tok.normalizer, self.tok.pre_tokenizer = parts

    def clear(self):
        self.at, self.bytes = _Numbers(), 0
        self.flat = np.empty(0, "<u4")
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def pieces(self, text: str) -> list[str]:
        if not self.whole.search(text):
            return self.PIECE.findall(text.lower())
        out: list[str] = []
        for w in self.SPACE.split(text):
            if self.whole.search(w):
                out.append(w)
            else:
                out += self.PIECE.findall(w.lower())
        return out

    def _learn(self):
        """Ids of the new pieces: runs of letters go in long lines, cut at the marks."""
        new, self.at.new = self.at.new, []
        run = np.fromiter((self.LETTERS.match(w) is not None for w in new), bool, len(new)) & (len(self.mark) == 1)
        runs, others = [w for w, r in zip(new, run) if r], [w for w, r in zip(new, run) if not r]
        flat, sizes = [], []
        self._use(self.plain)
        for i in range(0, len(runs), LINE):
            line = np.array(self._ids([f" {self.MARK} ".join(runs[i:i + LINE])])[0], "<u4")
            marks = np.flatnonzero(line == self.mark[0])
            sizes.append(np.diff(np.concatenate(([-1], marks, [len(line)]))) - 1)
            flat.append(np.delete(line, marks))
        self._use(self.own)
        for ids in self._ids(others):
            sizes.append(np.array([len(ids)]))
            flat.append(np.array(ids, "<u4"))
        got = np.concatenate(sizes)
        order = np.concatenate((np.flatnonzero(run), np.flatnonzero(~run)))
        start, size = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        start[order], size[order] = len(self.flat) + np.cumsum(got) - got, got
        self.start, self.size = np.concatenate((self.start, start)), np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, *flat))
        self.bytes += sum(map(len, new)) + PIECE_BYTES * len(new) + 4 * int(got.sum())

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.bytes > CACHE_BYTES:
            self.clear()
        numbers = []
        for t in texts:
            ps = self.pieces(t)
            numbers.append(np.fromiter(map(self.at.__getitem__, ps), np.int64, len(ps)))
        if self.at.new:
            self._learn()
        out = []
        for k in numbers:
            size = self.size[k]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            ids = np.empty(total + 1, "<u4")
            ids[:total] = self.flat[np.arange(total) + np.repeat(self.start[k] - ends + size, size)]
            ids[total] = END_ID
            out.append(ids)
        return out


_KNOWN: dict[str, PieceIds] = {}


def known_pieces(tokenizer: str) -> PieceIds:
    """The Python worker's tokenizer: it outlives a task, as this module does, but the pieces
    do not. (A closure that reads ``_KNOWN`` itself would be sent an empty copy with every task.)"""
    if tokenizer not in _KNOWN:
        _KNOWN[tokenizer] = PieceIds(tokenizer)
    return _KNOWN[tokenizer]


def token_table(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH) -> DataFrame:
    """(``_row``, doc_id, ``_n``, ``_ids``, ``_full``): ids as little-endian uint32; a
    unique row number; the number of the document's first full sequence. Store it
    before use: the numbers follow the partitions."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_pieces(tokenizer)
        row = full = TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = known.encode(part.column(1).to_pylist())
                n = np.fromiter(map(len, ids), np.int64, len(ids))
                q = n // length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(ids))), part.column(0), pa.array(n),
                     pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(full + np.cumsum(q) - q)],
                    ["_row", "doc_id", "_n", "_ids", "_full"])
                row, full = row + len(ids), full + int(q.sum())
        known.clear()   # the worker lives on, its memory is the next task's
        give_back()

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"_row long, doc_id {id_type}, _n long, _ids binary, _full long")


# ---------------------------------------------------------------- patterns
def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """Unbounded knapsack by dynamic programming over the capacity: the worth of the
    best pattern and its item counts (by index)."""
    value, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    s, p = sizes[order], prices[order]
    upto = np.searchsorted(s, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        if upto[c]:
            v = value[c - s[:upto[c]]] + p[:upto[c]]
            k = int(v.argmax())
            if v[k] > value[c] + 1e-12:
                value[c], item[c] = v[k], k
    counts, c = Counter(), capacity
    while c > 0:
        if item[c] < 0:
            c -= 1
        else:
            counts[int(order[item[c]])] += 1
            c -= int(s[item[c]])
    return float(value[capacity]), dict(counts)


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], float]]:
    """Column generation for min sum(x) with sum(pattern * x) >= demand: the patterns
    of the last basis (item index -> count) and their real-valued use.

    Duals of a degenerate master swing widely, so pricing is stabilised: the knapsack
    sees a blend of the duals and of size / capacity, which is dual feasible and nearly
    optimal wherever sequences can be filled. A blend that finds nothing gives way to
    the duals themselves. Pricing ends within ``GAP`` of the area bound or of Farley's."""
    m = len(sizes)
    if not m:
        return []
    fit = capacity // sizes
    basis: list[dict[int, int]] = [{k: int(fit[k])} for k in range(m)]
    cost, inverse, x = np.ones(m), np.diag(1.0 / fit), demand / fit
    centre = sizes / capacity
    bound, blend = float(demand @ centre), BLEND
    for _ in range(MAX_PIVOTS):
        prices = cost @ inverse
        if float(cost @ x) <= bound * (1 + GAP):
            break
        low = int(prices.argmin())
        if prices[low] < -1e-9:  # more of this class than demanded is worth it
            pattern, price = {low: -1}, 0.0
        else:
            _, pattern = best_pattern((1 - blend) * centre + blend * prices, sizes, capacity)
            price = 1.0
            worth = sum(prices[k] * c for k, c in pattern.items())
            if worth <= 1 + 1e-7:
                if blend < 1:
                    blend = min(1.0, 2 * blend)
                    continue
                break
            if blend == 1:
                bound = max(bound, float(cost @ x) / worth)
        column = sum(inverse[:, k] * c for k, c in pattern.items())
        up = column > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / column[up]
        out = int(ratio.argmin())
        step = ratio[out]
        if not np.isfinite(step):
            break
        x = np.maximum(x - step * column, 0)
        x[out] = step
        pivot = inverse[out] / column[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
        basis[out], cost[out] = pattern, price
    return [(p, float(v)) for p, c, v in zip(basis, cost, x) if c]


def trimmed(pattern: dict[int, int], times: int, left: np.ndarray) -> Iterator[tuple[dict[int, int], int]]:
    """``times`` sequences of a pattern as far as there are documents ``left`` (lowered
    in place): items that ran out are missing from the later ones."""
    while times > 0 and (items := {k: int(min(c, left[k])) for k, c in pattern.items() if left[k] > 0}):
        n = int(min(times, *(left[k] // c for k, c in items.items())))
        for k, c in items.items():
            left[k] -= c * n
        times -= n
        yield items, n


def first_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """First-fit decreasing of what is left of each class: sequences and how many there
    are of each. Equal neighbours are handled at once, so the work does not grow with
    the counts."""
    bins: list[tuple[dict[int, int], int, int]] = []  # items, free, times
    for k in np.argsort(-sizes).tolist():
        n, size, new = int(left[k]), int(sizes[k]), []
        for items, free, times in bins + [({}, capacity, int(left[k]))]:
            each = free // size
            whole = min(times, n // each) if each else 0
            part = n - whole * each if each and whole < times else 0
            n -= whole * each + part
            new += [({**items, k: each}, free - each * size, whole), ({**items, k: part}, free - part * size, int(part > 0))]
            if items:
                new.append((items, free, times - whole - (part > 0)))
        bins = [b for b in new if b[2] > 0]
    return [(items, times) for items, _, times in bins]


def layout(hist: dict[int, int], capacity: int, mean: dict[int, float] | None = None) -> tuple[list[tuple[int, int, int, int, int, int]], dict[int, int], int]:
    """From the demand by class (size in units): rows (class, rank from, rank to, first
    sequence, documents of the class in a sequence, first slot), the ranks from which a
    class's documents are recut, and the number of sequences. ``mean`` has the classes'
    mean sizes in units, their upper bounds if not given; fills are reckoned with them."""
    sizes = np.array(sorted(hist), np.int64)
    demand = np.array([hist[int(s)] for s in sizes], np.int64)
    mean = mean or {int(s): float(s) for s in sizes}
    fill = lambda items: sum(mean[int(sizes[k])] * c for k, c in items.items())
    plan: list[tuple[dict[int, int], int]] = []
    left = demand.copy()
    # The fullest go first: what a class is over-covered by is missing from the others.
    for pattern, use in sorted(solve_patterns(sizes, demand.astype(float), capacity), key=lambda p: -fill(p[0])):
        plan += trimmed(pattern, int(use + 1e-7), left)
    plan = [b for b in plan + first_fit(sizes, left, capacity) if fill(b[0]) >= GOOD_FILL * capacity]
    done, seq, rows = np.zeros(len(sizes), np.int64), 0, []
    for pattern, times in plan:
        slot = 0
        for k, c in sorted(pattern.items(), reverse=True):
            rows.append((int(sizes[k]), int(done[k]), int(done[k]) + c * times, seq, c, slot))
            done[k] += c * times
            slot += c
        seq += times
    return rows, {int(s): int(d) for s, d in zip(sizes, done)}, seq


# ---------------------------------------------------------------- pieces
def pack(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, grain: int = GRAIN,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, if asked for, the piece's token ids (``ids``, little-endian uint32 bytes).

    Null and empty texts consist of the end id alone. Repeated rows are packed once
    each, every copy with its own pieces. Other columns are not read; an empty table
    gives an empty result. Sequences other than recut ones are filled to within
    ``grain`` - 1 tokens per piece of what their pattern holds, and on average over a
    class's documents to ``GOOD_FILL``.
    """
    spark = docs.sparkSession
    tokens = written(spark, token_table(docs, tokenizer, length), "pack_tokens")
    rest = (tokens.select("_row", (F.col("_n") % length).alias("_rem"), "_n").where("_rem > 0")
            .withColumn("_class", F.ceil(F.col("_rem") / grain).cast("int")))
    classes = rest.groupBy("_class").agg(F.count(F.lit(1)), F.avg("_rem") / grain).collect()  # at most length/grain rows
    hist = {r[0]: r[1] for r in classes}
    rows, recut_from, n_seq = layout(hist, length // grain, {r[0]: r[2] for r in classes})

    salts = n_salts(sum(hist.values()))
    ranked = rank_in_groups(rest, ["_class"], [F.xxhash64("_row"), F.col("_row")], F.xxhash64("_row"), salts, "_rank")
    ranked = written(spark, ranked, "pack_ranks")
    plan = spark.createDataFrame(rows or [(0, 0, 0, 0, 1, 0)],
                                 "_class int, _from long, _to long, _seq long, _each long, _slot long")
    k = F.col("_rank") - F.col("_from")
    placed = (ranked.join(F.broadcast(plan), "_class").where("_rank >= _from and _rank < _to")
              .select("_row", (F.col("_n") - F.col("_rem")).alias("start"), F.col("_rem").alias("length"),
                      (F.col("_seq") + F.floor(k / F.col("_each"))).alias("seq"),
                      (F.col("_slot") + k % F.col("_each")).alias("_at")))
    first = spark.createDataFrame(list(recut_from.items()) or [(0, 0)], "_class int, _first long")
    pool = (ranked.join(F.broadcast(first), "_class").where("_rank >= _first")
            .select("_row", "_n", "_rem", "_class", "_rank"))
    pool = written(spark, pool, "pack_pool")
    recut, n_recut = _recut(pool, n_seq, length)
    pieces = placed.unionByName(recut)
    before = Window.partitionBy("seq").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (pieces.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
              .groupBy("_row").agg(F.collect_list(F.struct("start", "length", "seq", "offset")).alias("_pieces")))
    return _cut(tokens.join(pieces, "_row", "left"), n_seq + n_recut, length, with_ids)


def _recut(pool: DataFrame, first_seq: int, length: int) -> tuple[DataFrame, int]:
    """Lays the pool's remainders end to end and cuts them; also how many sequences. A
    remainder's place adds up the classes before its own (at most length / grain, from
    the driver), the blocks of ranks before its own and the ranks before it."""
    total, starts = 0, []
    for c, n in sorted(pool.groupBy("_class").agg(F.sum("_rem")).collect(), reverse=True):
        starts.append((c, total))
        total += int(n)
    full, tail = divmod(total, length)
    marks, at = [], full * length  # where the stretches of the tail begin, powers of two
    for p in range(tail.bit_length() - 1, -1, -1):
        if tail >> p & 1:
            marks.append(at)
            at += 1 << p
    d = pool.withColumn("_block", F.floor(F.col("_rank") / RECUT_BLOCK))
    before = Window.partitionBy("_class").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (d.groupBy("_class", "_block").agg(F.sum("_rem").alias("_sum"))
              .select("_class", "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")))
    inner = Window.partitionBy("_class", "_block").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    first = pool.sparkSession.createDataFrame(starts or [(0, 0)], "_class int, _start long")
    d = (d.join(blocks, ["_class", "_block"]).join(F.broadcast(first), "_class")
         .withColumn("_to", F.col("_start") + F.col("_before") + F.sum("_rem").over(inner))
         .withColumn("_from", F.col("_to") - F.col("_rem")))
    low = F.floor(F.col("_from") / length) + 1
    high = F.least(F.ceil(F.col("_to") / length) - 1, F.lit(full))
    every = F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda j: j * length)).otherwise(
        F.array().cast("array<bigint>"))
    marked = F.array(*[F.lit(int(m)) for m in marks]).cast("array<bigint>")
    inside = F.array_sort(F.filter(F.array_union(every, marked), lambda c: (c > F.col("_from")) & (c < F.col("_to"))))
    d = d.withColumn("_cuts", F.concat(F.array(F.col("_from")), inside, F.array(F.col("_to"))))
    d = d.select("*", F.posexplode(F.slice("_cuts", 1, F.size("_cuts") - 1)).alias("_j", "_at"))
    end = F.element_at("_cuts", F.col("_j") + 2)
    tail_no = reduce(lambda c, m: c + (F.col("_at") >= m).cast("long"), marks, F.lit(0).cast("long"))
    seq = F.when(F.col("_at") < full * length, F.floor(F.col("_at") / length)).otherwise(full - 1 + tail_no)
    return d.select("_row", (F.col("_n") - F.col("_rem") + F.col("_at") - F.col("_from")).alias("start"),
                    (end - F.col("_at")).alias("length"), (F.lit(first_seq) + seq).cast("long").alias("seq"),
                    "_at"), full + len(marks)


def _cut(tokens: DataFrame, first_full: int, length: int, with_ids: bool) -> DataFrame:
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, cells, ids_of = [], [], []
            for i, (n, ids, full, pieces) in enumerate(zip(*[b.column(c).to_pylist() for c in range(1, 5)])):
                cuts = [(j * length, length, first_full + full + j, 0) for j in range(n // length)]
                cuts += [(p["start"], p["length"], p["seq"], p["offset"]) for p in sorted(pieces or [], key=lambda p: p["start"])]
                for s, m, seq, off in cuts:
                    part = ids[4 * s:4 * (s + m)]
                    owner.append(i)
                    cells.append((s, m, zlib.crc32(part), n, seq, off))
                    ids_of.append(part if with_ids else None)
            cols = list(zip(*cells)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c, pa.int64()) for c in cols],
                 pa.array(ids_of, pa.binary())], names)

    out = tokens.select("doc_id", "_n", "_ids", "_full", "_pieces").mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             "offset long, ids binary")
    return out if with_ids else out.drop("ids")
