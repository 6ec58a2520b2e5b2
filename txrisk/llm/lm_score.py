"""Language-model scoring by context-tree weighting.

A byte is eight binary decisions (its bits, highest first). Every decision has a
context tree over the preceding ``DEPTH`` bytes: a node at depth d counts the zeros and
ones seen after d given bytes. Krichevsky-Trofimov block probabilities and the
weighting  Pw = (KT + product of the children's Pw) / 2  give each node its posterior
weight, and a decision's probability mixes the KT estimates of all depths on its path
by these weights. A path ends where training has seen no more of the context. The sum over
a text's bytes and its end mark is the score.

The counts are those of (context, byte) grams. Nothing of them is broadcast or
collected; all of it moves by key:

1. Documents are dealt into chunks of about ``CHUNK_BYTES`` by a hash (repeats of a row
   that would fill a chunk by a stored row number). A chunk counts
   its grams and words (pre-aggregation) and sends them on in parts by a hash of the key.
2. A part adds its keys' training counts over all chunks. Distinct grams then go by
   their last context bytes to the task that has this part of the tree.
3. Tree tasks weight their nodes bottom-up; the nodes of depths 1 and 0 (at most 256
   and 1 context, 255 decisions each) are added up from them. Each distinct gram gets
   its log probability.
4. Parts answer every chunk for the grams and words it has, and the chunk, joined with
   its answers, scores its documents.

The chunks' texts are shuffled once: both steps that need them read the same exchange.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import chunked_by_row, text_of

DEPTH = 5
CHUNK_BYTES = 8 << 20
SUBTREES = 16        # tree tasks per last byte
HELD_OUT = 1         # remainder of crc32(id) mod 5 that is not trained on
HALF = math.log(0.5)


# ---------------------------------------------------------------- context tree
def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5 by Stirling's series above 8."""
    x = np.asarray(x, float)
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] -= np.log(y[low])
        y[low] += 1
    r = 1 / (y * y)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r / 1260)) / y


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log KT block probability of n0 zeros and n1 ones."""
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - math.log(math.pi)


def _weigh(n0, n1, children):
    """Weighted log probability of inner nodes and the posterior weight of stopping."""
    own = HALF + log_kt(n0, n1)
    both = np.logaddexp(own, HALF + children)
    return both, np.exp(own - both)


def _sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _at(gram: np.ndarray, d: int, k: int, depth: int) -> np.ndarray:
    """Node of the k-th decision of grams in their depth-d context."""
    return ((gram >> (8 + 8 * (depth - d))) << 8) | ((gram & 255) >> (8 - k))


class Tree:
    """Nodes of depths ``depth`` to 2 above some grams: per depth and decision sorted
    node keys, counts, and the weight of stopping."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int):
        self.depth, self.nodes = depth, {}
        seen = counts > 0
        grams, counts = grams[seen], counts[seen].astype(float)
        for d in range(depth, 1, -1):
            for k in range(8):
                ones = counts * ((grams >> (7 - k)) & 1)
                node = _at(grams, d, k, depth)
                keys, n = _sum_by(node, counts)
                n1 = _sum_by(node, ones)[1]
                if d == depth:
                    lp, w = log_kt(n - n1, n1), np.ones(len(keys))
                else:
                    below, _, _, child, _ = self.nodes[d + 1, k]
                    up = np.searchsorted(keys, ((below >> 16) << 8) | (below & 255))
                    lp, w = _weigh(n - n1, n1, np.bincount(up, weights=child, minlength=len(keys)))
                self.nodes[d, k] = keys, n - n1, n1, lp, w

    def top(self) -> tuple[np.ndarray, np.ndarray]:
        """Per decision node (1 to 255) the sums over this tree's depth-2 nodes that
        the depth-1 node needs: rows zeros, ones, log probability."""
        out = np.zeros((3, 256))
        for k in range(8):
            keys, n0, n1, lp, _ = self.nodes[2, k]
            j = (1 << k) | (keys & 255)
            for row, v in enumerate((n0, n1, lp)):
                np.add.at(out[row], j, v)
        return out

    def log10_prob(self, grams: np.ndarray, one: np.ndarray, root: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's byte in its context. ``one`` and ``root``:
        zeros, ones and stopping weight of the depth-1 and depth-0 decisions."""
        total = np.zeros(len(grams))
        for k in range(8):
            bit = ((grams >> (7 - k)) & 1).astype(bool)
            p, seen = np.full(len(grams), 0.5), np.zeros(len(grams), bool)
            for d in range(self.depth, 1, -1):
                keys, n0, n1, _, w = self.nodes[d, k]
                if not len(keys):
                    continue
                node = _at(grams, d, k, self.depth)
                i = np.minimum(np.searchsorted(keys, node), len(keys) - 1)
                hit = keys[i] == node
                kt = (np.where(bit, n1[i], n0[i]) + 0.5) / (n0[i] + n1[i] + 1)
                p = np.where(hit, np.where(seen, w[i] * kt + (1 - w[i]) * p, kt), p)
                seen |= hit
            j = (1 << k) | ((grams & 255) >> (8 - k))
            for n0, n1, w in (one, root):
                n = n0[j] + n1[j]
                kt = (np.where(bit, n1[j], n0[j]) + 0.5) / (n + 1)
                p = np.where(n > 0, np.where(seen, w[j] * kt + (1 - w[j]) * p, kt), p)
                seen |= n > 0
            total += np.log10(p)
        return total


# ---------------------------------------------------------------- chunks
def _grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all bytes and end marks of some lower-cased texts, and how many each
    text has. A gram: the ``depth`` bytes before (last one highest), then the byte;
    zeros stand before a text, a zero byte ends it."""
    pad = b"\0" * depth
    x = np.frombuffer(b"".join(pad + t + b"\0" for t in texts), np.uint8)
    n = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    inside = np.ones(len(x), bool)
    begin = np.cumsum(n + depth) - n - depth
    for d in range(depth):
        inside[begin + d] = False
    gram = x.astype(np.int64)
    for d in range(1, depth + 1):
        gram[d:] |= x[:-d].astype(np.int64) << (8 * (depth + 1 - d))
    return gram[inside], n


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    mixed = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.uint64(parts)).astype(np.int64)


def _split(keys: np.ndarray, values: np.ndarray, part: np.ndarray):
    """(part, keys, values) of every part that has keys."""
    order = np.argsort(part, kind="stable")
    keys, values, part = keys[order], values[order], part[order]
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
    for a, b in zip(first, [*first[1:], len(part)]):
        yield int(part[a]), keys[a:b], values[a:b]


def _word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64)


def _pack(values: np.ndarray) -> bytes:
    """Values by byte planes, deflated; int64 ones as differences (small if sorted)."""
    if values.dtype == np.int64:
        values = np.diff(values, prepend=np.int64(0))
    return zlib.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _load(data: bytes, dtype=np.int64) -> np.ndarray:
    if not data:
        return np.empty(0, dtype)
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    values = np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
    return np.cumsum(values) if dtype == np.int64 else values


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


PACKED = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())])
PACKED_DDL = "part long, chunk long, keys binary, vals binary"


def _texts(table: pa.Table) -> list[bytes]:
    return [t.encode("utf-8", "replace").lower() for t in table.column("text").to_pylist()]


def _blocks(texts: list[bytes], size: int = 1 << 20):
    """Runs of texts with about ``size`` bytes."""
    at = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def emit(parts: int, depth: int):
    """Counts of a chunk: words in parts 0 to parts-1, grams in the parts after; keys
    that only held-out texts have count 0."""
    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        texts, held = _texts(table), table.column("held_out").to_numpy(zero_copy_only=False)
        index: dict[bytes, int] = {}
        trained: list[np.ndarray] = []
        for t, h in zip(texts, held):
            at = np.array([index.setdefault(w, len(index)) for w in t.split()], np.int64)
            if not h:
                trained.append(at)
        counts = np.bincount(np.concatenate([*trained, np.empty(0, np.int64)]), minlength=len(index))
        ends = len(texts) - int(held.sum())  # the end token has the key 0 and counts once a text
        keys = np.concatenate((_word_keys(list(index)), [0])).astype(np.int64)
        index.clear()
        order = np.argsort(keys)
        keys, counts = keys[order], np.concatenate((counts, [ends])).astype(np.int32)[order]
        rows = [(p, chunk, _pack(k), _pack(v)) for p, k, v in _split(keys, counts, _part(keys, parts))]
        grams = {}
        for h in (False, True):
            mine = [t for t, x in zip(texts, held) if bool(x) == h]
            got = [np.unique(_grams(mine[a:b], depth)[0], return_counts=True) for a, b in _blocks(mine)]
            k = np.concatenate([g for g, _ in got] + [np.empty(0, np.int64)])
            c = np.concatenate([n for _, n in got] + [np.empty(0, np.int64)])
            grams[h] = k, c * (not h)
        k, c = _sum_by(*[np.concatenate((grams[False][i], grams[True][i])) for i in (0, 1)])
        rows += [(parts + p, chunk, _pack(g), _pack(v.astype(np.int32))) for p, g, v in _split(k, c, _part(k, parts))]
        return _table(rows, PACKED)
    return run


def _unpack(table: pa.Table, column: str, dtype=np.int64) -> list[np.ndarray]:
    return [_load(x, dtype) for x in table.column(column).to_pylist()]


def _totals(table: pa.Table, dtype=np.int32) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts: int32 from chunks, float64 from sums of chunks."""
    return _sum_by(np.concatenate(_unpack(table, "keys")), np.concatenate(_unpack(table, "vals", dtype)).astype(np.int64))


SUMS = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("distinct", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())])
SUMS_DDL = "tree long, n long, distinct long, keys binary, vals binary"


def add_up(parts: int, depth: int):
    """Totals over all chunks: of word parts the number of tokens and of distinct ones,
    of gram parts the grams by tree."""
    def run(table: pa.Table) -> pa.Table:
        keys, n = _totals(table)
        if table.column("part")[0].as_py() < parts:
            return _table([(-1, int(n.sum()), int((n > 0).sum()), b"", b"")], SUMS)
        last, before = keys >> (8 * depth), (keys >> (8 * (depth - 1))) & 255
        return _table([(t, 0, 0, _pack(k), _pack(v)) for t, k, v in _split(
            keys, n.astype(np.float64), last * SUBTREES + before % SUBTREES)], SUMS)
    return run


TOP = pa.schema([("last", pa.int64()), ("j", pa.int64()), ("n0", pa.float64()), ("n1", pa.float64()), ("lp", pa.float64())])
TOP_DDL = "last long, j long, n0 double, n1 double, lp double"


def tree_top(depth: int):
    def run(table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        n0, n1, lp = Tree(*_totals(table, np.float64), depth).top()
        return _table([(tree // SUBTREES, int(j), n0[j], n1[j], lp[j]) for j in np.flatnonzero(n0 + n1)], TOP)
    return run


def _decisions(nodes: list[dict] | None) -> np.ndarray:
    """Zeros, ones, stopping weight and weighted log probability by decision."""
    out = np.zeros((3, 256))
    for x in nodes or []:
        out[:, x["j"]] = x["n0"], x["n1"], x["lp"]
    lp, w = _weigh(out[0], out[1], out[2])
    return np.stack((out[0], out[1], w, lp))


def weigh_top(batches):
    """(j, n0, n1, lp) of the weighted depth-1 nodes of each last byte."""
    for b in batches:
        rows = []
        for last, nodes in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            n0, n1, _, lp = _decisions(nodes)
            rows += [(last, int(j), n0[j], n1[j], lp[j]) for j in np.flatnonzero(n0 + n1)]
        yield from _table(rows, TOP).to_batches()


def probabilities(parts: int, depth: int):
    """Log10 probabilities of a tree's grams, by part."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([], PACKED)
        grams, n = _totals(left, np.float64)
        one = _decisions(right.column("nodes")[0].as_py() if right.num_rows else None)
        root = _decisions(right.column("root")[0].as_py() if right.num_rows else None)
        p = Tree(grams, n, depth).log10_prob(grams, one[:3], root[:3])
        return _table([(parts + q, -1, _pack(k), _pack(v)) for q, k, v in _split(grams, p, _part(grams, parts))], PACKED)
    return run


def answer(parts: int):
    """What a part has for the keys of each chunk: training counts of words, log
    probabilities of grams (as doubles)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([], PACKED)
        part = left.column("part")[0].as_py()
        if part < parts:
            keys, vals = _totals(left)
        else:
            keys = np.concatenate(_unpack(right, "keys"))
            vals = np.concatenate(_unpack(right, "vals", np.float64))
            order = np.argsort(keys)
            keys, vals = keys[order], vals[order]
        vals = vals.astype(np.float64 if part < parts else np.float32)
        return _table([(part, c, _pack(k), _pack(vals[np.searchsorted(keys, k)])) for c, k in zip(
            left.column("chunk").to_pylist(), _unpack(left, "keys"))], PACKED)
    return run


class _Lookup:
    """Values by key: a table of slots holds most keys, a sorted search the others."""

    def __init__(self, keys: np.ndarray, vals: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.vals = keys[order], vals[order]
        self.bits = max(8, int(len(keys)).bit_length() + 3)
        self.slots = np.zeros(1 << self.bits, np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys):
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def get(self, keys: np.ndarray) -> np.ndarray:
        i = self.slots[self._slot(keys)]
        lost = np.flatnonzero(self.keys[i] != keys)
        if len(lost):
            i[lost] = np.searchsorted(self.keys, keys[lost])
        return self.vals[i]


def score_chunk(parts: int, depth: int, names: list[str], schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        part = right.column("part").to_numpy(zero_copy_only=False)
        keys = right.column("keys").to_pylist()
        vals = right.column("vals").to_pylist()
        n_train, n_distinct = (int(right.column(c)[0].as_py() or 0) for c in ("train_tokens", "train_distinct"))

        def lookup(mine, dtype):
            return _Lookup(np.concatenate([_load(keys[i]) for i in mine]),
                           np.concatenate([_load(vals[i], dtype) for i in mine]))

        words, grams = lookup(np.flatnonzero(part < parts), np.float64), lookup(np.flatnonzero(part >= parts), np.float32)
        keys.clear()
        vals.clear()
        texts = _texts(left)
        index: dict[bytes, int] = {}
        of_doc = [np.array([index.setdefault(w, len(index)) for w in t.split()], np.int64) for t in texts]
        c = words.get(np.concatenate((_word_keys(list(index)), [0])).astype(np.int64))
        base = np.log10((c + 0.5) / (n_train + 0.5 * (n_distinct + 1)))
        n_tokens = np.array([len(d) + 1 for d in of_doc], np.int64)
        n_known = np.array([int((c[d] > 0).sum()) + int(c[-1] > 0) for d in of_doc], np.int64)
        base_score = np.array([float(base[d].sum() + base[-1]) for d in of_doc])
        score = np.zeros(len(texts))
        for a, b in _blocks(texts):
            g, n = _grams(texts[a:b], depth)
            score[a:b] = np.add.reduceat(grams.get(g).astype(float), np.cumsum(n) - n)
        n_bytes = np.fromiter(map(len, texts), np.int64, len(texts))
        got = {"n_tokens": n_tokens, "n_known": n_known, "train_tokens": np.full(len(texts), n_train, np.int64),
               "base_score": base_score, "score": score, "n_bytes": n_bytes,
               "bits_per_byte": -score / math.log10(2) / (n_bytes + 1)}
        return pa.table([left.column(n) if n in ("doc_id", "held_out") else pa.array(got[n]) for n in names], schema=schema)
    return run


def ctw_scores(docs: DataFrame, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, n_bytes, bits_per_byte (code length per byte, end mark included).

    Null texts count as empty: one end token, the end mark's score. Repeated rows are
    scored (and trained on) each; a null id counts as an empty one for the split, so it
    is trained on. Without training rows every decision has probability 1/2. Other
    columns are not read; an empty table gives an empty result. Words are counted by
    64-bit hashes.
    """
    spark = docs.sparkSession
    d = docs.select("doc_id", text_of().alias("text"))
    row_size = F.octet_length("text") + 16
    size = d.agg(F.sum(row_size)).head()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    parts = chunks
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    d = chunked_by_row(d.withColumn("held_out", F.crc32(id_text.cast("binary")) % 5 == HELD_OUT),
                       row_size, chunks, chunk_bytes)
    sent = d.groupBy("chunk").applyInArrow(emit(parts, depth), PACKED_DDL)
    sums = sent.groupBy("part").applyInArrow(add_up(parts, depth), SUMS_DDL)
    words = sums.where("tree < 0").agg(F.sum("n").alias("n"), F.sum("distinct").alias("v"))
    trees = sums.where("tree >= 0").select("tree", "keys", "vals")
    node = F.struct(F.col("j").cast("int").alias("j"), "n0", "n1", "lp")
    add = [F.sum(c).alias(c) for c in ("n0", "n1", "lp")]
    one = (trees.groupBy("tree").applyInArrow(tree_top(depth), TOP_DDL).groupBy("last", "j").agg(*add)
           .groupBy("last").agg(F.collect_list(node).alias("nodes")))
    root = one.mapInArrow(weigh_top, TOP_DDL).groupBy("j").agg(*add).agg(F.collect_list(node).alias("root"))
    tops = (one.withColumn("root", root.scalar())
            .select(F.explode(F.sequence(F.col("last") * SUBTREES, F.col("last") * SUBTREES + SUBTREES - 1)).alias("tree"),
                    "nodes", "root"))
    model = trees.groupBy("tree").cogroup(tops.groupBy("tree")).applyInArrow(probabilities(parts, depth), PACKED_DDL)
    replies = sent.groupBy("part").cogroup(model.groupBy("part")).applyInArrow(answer(parts), PACKED_DDL)
    replies = (replies.withColumn("train_tokens", words.select("n").scalar())
               .withColumn("train_distinct", words.select("v").scalar()))
    id_type = docs.schema["doc_id"].dataType
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
    ddl = (f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double, n_bytes long, bits_per_byte double")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return d.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(score_chunk(parts, depth, names, schema), ddl)
