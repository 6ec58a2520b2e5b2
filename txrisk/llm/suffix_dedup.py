"""Removal of long repeated passages by bucket-pointer refinement.

Texts are UTF-8 byte strings. A byte goes when some ``LENGTH``-byte string that covers
it also starts in a document with a smaller id. Suffixes are put into buckets that are
refined until they agree on ``LENGTH`` bytes:

- A suffix's first bucket is its 8-gram, itself a 64-bit number. Refinement pairs its
  bucket with that of a later offset: (8, 8 bytes on) gives 16, (16, 8 on) the
  ``GRAM`` = 24 bytes, (16, 16 on) 32, (32, 18 on) 50. Each pass reuses the identifiers of the one
  before, and an identifier is a 64-bit mix of the pair, so tasks agree on it without
  a global sort.
- Only suffixes whose bucket still holds several documents are refined further. A
  50-byte string is represented by the least of the 24-gram buckets inside it (the
  anchor); equal strings have equal anchors. Consecutive strings with one anchor form a zone.

Rounds, each a shuffle by key of what a chunk of documents has (pre-aggregated):

1. Anchors: those found in one document only end here.
2. Zones of the others, refined over all their bytes. A zone that a smaller document has as
   well is covered at once. One that no smaller document has needs no more if its
   anchor has no other zone anywhere.
3. The 50-byte buckets of what is left: the least document of each decides.

Copies of a passage cost a chunk one key. The chunks' texts are shuffled once; all
rounds read the same exchange. Sorting happens inside tasks over a part of the keys.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import chunked_by_row, text_of

LENGTH = 50          # fixed by the refinement steps 8, 16, 32, 50
GRAM = 24
CHUNK_BYTES = 8 << 20
PART_BYTES = 48 << 20
BLOCK_BYTES = 1 << 20
SPAN = LENGTH - GRAM + 1
NULL_ID = np.iinfo(np.int64).max

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _M1
    h ^= h >> np.uint64(29)
    h += b
    h *= _M2
    h ^= h >> np.uint64(32)
    return h


class Buckets:
    """Bucket identifiers of the suffixes of a byte array, refined pass by pass."""

    def __init__(self, x: np.ndarray):
        x = x.astype(np.uint64)
        two = (x[:-1] << np.uint64(8)) | x[1:]
        four = (two[:-2] << np.uint64(16)) | two[2:]
        self.b8 = (four[:-4] << np.uint64(32)) | four[4:]
        self.b16 = _mix(self.b8[:-8], self.b8[8:])

    def anchors(self) -> np.ndarray:
        """Least 24-byte bucket inside each 50-byte string."""
        low, k = _mix(self.b16[:-8], self.b8[16:]), 1
        while 2 * k <= SPAN:
            low = np.minimum(low[:-k], low[k:])
            k *= 2
        return np.minimum(low[:-(SPAN - k)], low[SPAN - k:]) if k < SPAN else low

    def b50(self) -> np.ndarray:
        b32 = _mix(self.b16[:-16], self.b16[16:])
        return _mix(b32[:-18], b32[18:])


class Zones:
    """Zones of some texts: text index, first and last string start (in the text),
    anchor (48 bits) and, if asked for, the identifier of all bytes of the zone."""

    def __init__(self, texts: list[bytes], refine: bool):
        cols = [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2
        found = [self._block(texts, a, b, refine) for a, b in _blocks(texts)]
        parts = [np.concatenate(x) for x in zip(cols, *found)] if found else cols
        self.text, self.first, self.last, self.anchor, self.ident = parts

    @staticmethod
    def _block(texts, a, b, refine):
        n = np.fromiter(map(len, texts[a:b]), np.int64, b - a)
        begin = np.cumsum(n) - n
        x = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        if len(x) < LENGTH:
            return [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2
        buckets = Buckets(x)
        low = buckets.anchors()
        long = n >= LENGTH
        edge = np.zeros(len(x) + 1, np.int64)
        np.add.at(edge, begin[long], 1)
        np.add.at(edge, (begin + n - LENGTH + 1)[long], -1)
        inside = np.cumsum(edge)[:len(low)] > 0
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (low[1:] != low[:-1])
        new[begin[long]] = True
        end = inside.copy()
        end[:-1] &= ~inside[1:] | new[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(end)
        # A zone of more than SPAN strings (its anchor recurs) is divided.
        k = (last - first) // SPAN + 1
        step = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        first, last = np.repeat(first, k) + step * SPAN, np.repeat(last, k)
        last = np.minimum(last, first + SPAN - 1)
        anchor = low[first] >> np.uint64(16)
        ident = np.zeros(0, np.uint64)
        if refine:
            whole = buckets.b50()
            ident = _mix(_mix(whole[first], whole[last]), (last - first).astype(np.uint64))
        text = np.searchsorted(begin, first, "right") - 1
        return [text + a, first - begin[text], last - begin[text], anchor, ident]


def _blocks(texts: list[bytes]):
    at = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= BLOCK_BYTES:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


# ---------------------------------------------------------------- packed rows
ROW = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
DDL = "part long, chunk long, a binary, b binary, c binary"


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in ROW]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, ROW)], schema=ROW)


def _short(keys: np.ndarray) -> bytes:
    """48-bit keys in 6 bytes each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _wide(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _pack_docs(ids: np.ndarray) -> bytes:
    own, at = np.unique(ids, return_inverse=True)
    return np.int64(len(own)).tobytes() + own.astype(np.int64).tobytes() + at.astype(np.uint16 if len(own) < 65536 else np.uint32).tobytes()


def _docs(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    own = np.frombuffer(data, np.int64, n, 8)
    return own[np.frombuffer(data, np.uint16 if n < 65536 else np.uint32, -1, 8 + 8 * n)]


def _pack_ints(x: np.ndarray) -> bytes:
    """int32 values by byte planes, deflated."""
    return zlib.compress(x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<i4").astype(np.int64)


def _pack_places(place: np.ndarray) -> bytes:
    """(text, first, last) as differences: small numbers where the rows are in order."""
    text, first, last = place
    return _pack_ints(np.concatenate((np.diff(text, prepend=0), np.diff(first, prepend=0), last - first)))


def _places(data: bytes) -> np.ndarray:
    text, first, size = _ints(data).reshape(3, -1)
    first = np.cumsum(first)
    return np.stack((np.cumsum(text), first, first + size))


def _merged(place: np.ndarray) -> np.ndarray:
    """Zones in order, those that follow each other as one."""
    text, first, last = place[:, np.lexsort((place[1], place[0]))]
    if not len(text):
        return place
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (first[1:] > last[:-1] + 1)
    at = np.flatnonzero(new)
    return np.stack((text[at], first[at], np.maximum.reduceat(last, at)))


def _cut(part: np.ndarray):
    """(part, rows) for each part."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
    for a, b in zip(first, [*first[1:], len(part)]):
        yield int(part[a]), order[a:b]


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where groups of equal, sorted keys begin."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _first_docs(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the least document of each."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = _starts(keys)
    return keys[new], docs[new]


def _texts(table: pa.Table) -> tuple[list[bytes], np.ndarray, list[int]]:
    """Texts, ids and row numbers of a chunk in the order of (id, text): each round reads
    the exchange anew, and its row order may differ."""
    ids = table.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)
    texts = [t.encode("utf-8", "replace") for t in table.column("text").to_pylist()]
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return [texts[i] for i in order], ids[order], order


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


# ---------------------------------------------------------------- rounds
def send_anchors(parts: int):
    """(a: anchors, b: those of them in several documents of the chunk)."""
    def run(table: pa.Table) -> pa.Table:
        texts, ids, _ = _texts(table)
        z = Zones(texts, refine=False)
        anchor, doc = z.anchor, ids[z.text]
        order = np.argsort(anchor, kind="stable")
        anchor, doc = anchor[order], doc[order]
        first = np.flatnonzero(_starts(anchor))
        if not len(first):
            return _rows([])
        several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
        anchor, chunk = anchor[first], _column(table, "chunk")[0]
        return _rows([(p, chunk, _short(anchor[i]), _short(anchor[i][several[i]]), b"")
                      for p, i in _cut((anchor % np.uint64(parts)).astype(np.int64))])
    return run


def shared_anchors(table: pa.Table) -> pa.Table:
    """Replies per chunk (a): its anchors that several documents have."""
    sent = [_wide(x) for x in _column(table, "a")]
    every = np.sort(np.concatenate(sent))
    twice = every[1:][every[1:] == every[:-1]]
    shared = np.unique(np.concatenate([twice, *[_wide(x) for x in _column(table, "b")]]))
    out = []
    for chunk, keys in zip(_column(table, "chunk"), sent):
        at = np.minimum(np.searchsorted(shared, keys), max(len(shared) - 1, 0))
        mine = keys[shared[at] == keys] if len(shared) else keys[:0]
        if len(mine):
            out.append((0, chunk, _short(mine), b"", b""))
    return _rows(out)


def send_zones(parts: int):
    """Distinct zones by part of their anchor (a: anchors, b: identifiers, c: least
    documents), and the chunk's own state, which goes by the chunk (part ``parts`` +
    chunk; a: zones of those least documents, b: their numbers in the order sent, c:
    zones covered already, as the chunk has a smaller document with them)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows([])
        chunk = _column(left, "chunk")[0]
        texts, ids, _ = _texts(left)
        shared = np.sort(np.concatenate([_wide(x) for x in _column(right, "a")]))
        z = Zones(texts, refine=True)
        on = shared[np.minimum(np.searchsorted(shared, z.anchor), len(shared) - 1)] == z.anchor
        anchor, ident, doc = z.anchor[on], z.ident[on], ids[z.text[on]]
        place = np.stack((z.text[on], z.first[on], z.last[on]))
        order = np.lexsort((doc, ident, anchor))
        starts = _starts(anchor[order], ident[order])
        new = order[starts]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(starts) - 1
        rows, number, sent = [], np.empty(len(new), np.int64), 0
        for p, i in _cut((anchor[new] % np.uint64(parts)).astype(np.int64)):
            rows.append((p, chunk, _short(anchor[new[i]]), ident[new[i]].tobytes(), _pack_docs(doc[new[i]])))
            number[i] = np.arange(sent, sent + len(i))
            sent += len(i)
        least = doc == doc[new][group]
        return _rows([*rows, (parts + chunk, chunk, _pack_places(place[:, least]), _pack_ints(number[group[least]]),
                              _pack_places(_merged(place[:, ~least])))])
    return run


def resolve_zones(parts: int):
    """Replies per chunk (a: for each zone in the order sent, 1 if a smaller document
    has it, 2 if its anchor has other zones); a chunk's state passes."""
    def run(table: pa.Table) -> pa.Table:
        part = _column(table, "part")[0]
        if part >= parts:
            return table.select(ROW.names).cast(ROW)
        idents = [np.frombuffer(x, np.uint64) for x in _column(table, "b")]
        anchor = np.concatenate([_wide(x) for x in _column(table, "a")])
        ident, doc = np.concatenate(idents), np.concatenate([_docs(x) for x in _column(table, "c")])
        order = np.lexsort((doc, ident, anchor))
        anchor, ident, doc = anchor[order], ident[order], doc[order]
        new = _starts(anchor, ident)
        of_anchor = np.cumsum(_starts(anchor)) - 1
        many = np.bincount(of_anchor[new])[of_anchor] > 1
        status = np.empty(len(doc), np.uint8)
        status[order] = (doc > doc[new][np.cumsum(new) - 1]) + 2 * many
        cuts = np.cumsum([len(x) for x in idents])[:-1]
        return _rows([(part, c, x.tobytes(), b"", b"") for c, x in zip(_column(table, "chunk"), np.split(status, cuts))])
    return run


def _open_strings(texts: list[bytes], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """50-byte buckets, text and start of every string of some zones."""
    text, first, last = place
    ends = last + LENGTH
    x = np.frombuffer(b"".join([texts[t][a:b] for t, a, b in zip(text.tolist(), first.tolist(), ends.tolist())]), np.uint8)
    if not len(x):
        return np.empty(0, np.uint64), text[:0], first[:0]
    n, size = last - first + 1, ends - first
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return Buckets(x).b50()[np.repeat(np.cumsum(size) - size, n) + within], np.repeat(text, n), np.repeat(first, n) + within


def send_strings(parts: int):
    """50-byte buckets of the zones still open (a: buckets, b: least documents) by
    part, and the chunk's state (a: open zones, c: covered ones)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows([])
        chunk = _column(left, "chunk")[0]
        texts, ids, _ = _texts(left)
        replies = sorted(zip(*[_column(right, n) for n in ("part", "a", "b", "c")]))
        _, places, numbers, covered = replies.pop()  # the state has the highest part
        status = np.concatenate([np.frombuffer(x, np.uint8) for _, x, _, _ in replies])[_ints(numbers)]
        place = _places(places)
        smaller = (status & 1) > 0
        still = place[:, ~smaller & (status > 1)]
        covered = _merged(np.concatenate((_places(covered), place[:, smaller]), axis=1))
        state = (parts + chunk, chunk, _pack_places(still), b"", _pack_places(covered))
        bucket, text, _ = _open_strings(texts, still)
        bucket, doc = _first_docs(bucket, ids[text])
        return _rows([state, *[(p, chunk, bucket[i].tobytes(), _pack_docs(doc[i]), b"") for p, i in _cut(
            ((bucket >> np.uint64(20)) % np.uint64(parts)).astype(np.int64))]])
    return run


def resolve_strings(parts: int):
    """Replies per chunk (a: buckets that a smaller document has, b: the least one); a
    chunk's state passes."""
    def run(table: pa.Table) -> pa.Table:
        if _column(table, "part")[0] >= parts:
            return table.select(ROW.names).cast(ROW)
        buckets = [np.frombuffer(x, np.uint64) for x in _column(table, "a")]
        docs = [_docs(x) for x in _column(table, "b")]
        keys, least = _first_docs(np.concatenate(buckets), np.concatenate(docs))
        out = []
        for chunk, k, d in zip(_column(table, "chunk"), buckets, docs):
            first = least[np.searchsorted(keys, k)]
            less = first < d
            if less.any():
                out.append((-1, chunk, k[less].tobytes(), _pack_docs(first[less]), b""))
        return _rows(out)
    return run


def remove(parts: int, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        texts, ids, order_of_rows = _texts(left)
        runs = [np.empty((3, 0), np.int64)]
        open_zones, keys, docs = np.empty((3, 0), np.int64), [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for p, a, b, c in zip(*[_column(right, n) for n in ("part", "a", "b", "c")]):
            if p >= parts:
                open_zones = _places(a)
                runs.append(_places(c))
            else:
                keys.append(np.frombuffer(a, np.uint64))
                docs.append(_docs(b))
        bucket, text, start = _open_strings(texts, open_zones)
        if len(bucket):
            doc = ids[text]
            local, least = _first_docs(np.concatenate((bucket, *keys)), np.concatenate((doc, *docs)))
            hit = least[np.searchsorted(local, bucket)] < doc
            runs.append(np.stack((text[hit], start[hit], start[hit])))
        text, first, last = np.concatenate(runs, axis=1)
        order = np.lexsort((first, text))
        text, first, end = text[order], first[order], last[order] + LENGTH
        out = {"n_removed": np.zeros(len(texts), np.int64), "n_spans": np.zeros(len(texts), np.int64)}
        kept, spans = list(texts), [[] for _ in texts]
        for a, b in _groups(text):
            t = int(text[a])
            top = np.maximum.accumulate(end[a:b])
            new = np.ones(b - a, bool)
            new[1:] = first[a + 1:b] > top[:-1]
            s, e = first[a:b][new], np.concatenate((top[:-1][new[1:]], top[-1:]))
            out["n_removed"][t], out["n_spans"][t] = (e - s).sum(), len(s)
            raw = texts[t]
            kept[t] = b"".join(raw[i:j] for i, j in zip([0, *e.tolist()], [*s.tolist(), len(raw)]))
            spans[t] = [{"start": i, "end": j} for i, j in zip(s.tolist(), e.tolist())]
        return pa.table([left.column("doc_id").take(pa.array(order_of_rows)), pa.array(list(map(len, texts)), pa.int64()),
                         pa.array(out["n_removed"]), pa.array(out["n_spans"]),
                         pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                         pa.array(spans, schema.field("spans").type)], schema=schema)
    return run


def _groups(sorted_keys: np.ndarray):
    first = np.flatnonzero(_starts(sorted_keys)) if len(sorted_keys) else []
    return zip(first, [*first[1:], len(sorted_keys)])


def repeated_passages(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the
    removed byte ranges (``spans``: start, end).

    Null texts count as empty; texts under 50 bytes keep everything. Rows that repeat
    an id are one document to the rule, so neither takes from the other. A null id
    counts as larger than all others. Other columns are not read; an empty table gives
    an empty result. Buckets are compared by 64-bit identifiers.
    """
    id_type = docs.schema["doc_id"].dataType
    d = docs.select("doc_id", text_of().alias("text"))
    row_size = F.octet_length("text") + 64
    size = d.agg(F.sum(row_size)).head()[0] or 0
    chunks, parts = max(1, -(-size // chunk_bytes)), max(1, -(-size // part_bytes))
    d = d.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NULL_ID))))
    d = chunked_by_row(d, row_size, chunks, chunk_bytes)
    chunked = d.groupBy("chunk")
    anchors = chunked.applyInArrow(send_anchors(parts), DDL).groupBy("part").applyInArrow(shared_anchors, DDL)
    zones = (chunked.cogroup(anchors.groupBy("chunk")).applyInArrow(send_zones(parts), DDL)
             .groupBy("part").applyInArrow(resolve_zones(parts), DDL))
    strings = (chunked.cogroup(zones.groupBy("chunk")).applyInArrow(send_strings(parts), DDL)
               .groupBy("part").applyInArrow(resolve_strings(parts), DDL))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = (f"doc_id {id_type.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
           "spans array<struct<start: long, end: long>>")
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return chunked.cogroup(strings.groupBy("chunk")).applyInArrow(remove(parts, schema), ddl)
