"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint is embedded as the vector of its ``SEGMENTS`` two-bit segments' bit
counts (0, 1, 2). The Manhattan distance of two such vectors never exceeds the
Hamming distance, so links (``MAX_BITS`` = 4) lie within Manhattan distance 4. In
unary code (0, 1, 2 -> 00, 01, 11) the vector is again one 64-bit word and the
Manhattan distance the bit count of an XOR.

Grid range-join: the segments fall into three bands. A distance of 4 cannot exceed 1
in the first two bands and 0 in the third (that would take 2 + 2 + 1), so linked
vectors meet in a grid cell of some band: the cell of the band's vector, or, in the
first two bands, the neighbouring cell one count higher. Every distinct fingerprint
goes to its own cell of each band and probes the higher neighbours: about 20 narrow
rows. Inside a cell the Manhattan bound over all segments is checked, then the
Hamming distance itself.

Only distinct fingerprints take part, so copies cost nothing. A cell is handled in
blocks of at most ``BLOCK`` fingerprints (block against block), and a block pair gives
a spanning forest of its links instead of all of them, at most one row per
fingerprint. Components come from the forests by label propagation with pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import text_of, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 2048
PAIR_STEP = 1 << 21   # pairs checked at once in a task
ODD = 0x5555555555555555
#: Band masks over the unary code: 11, 11 and 10 two-bit segments.
BANDS = ((1 << 22) - 1, ((1 << 22) - 1) << 22, ((1 << 20) - 1) << 44)


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit b is 1 if it is set in over half of the shingles' XXH64; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:][:n].tolist()
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = np.array([hashed(joined[s:e], SEED) for s, e in zip(starts[at:min(n, at + 65536)].tolist(),
                                                                   last[at:at + 65536])], "<u8")
        ones += _bit_counts(part)
    return int(sum(1 << b for b in range(64) if 2 * int(ones[b]) > n))


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the words have each bit set."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``fp`` long) of every document, with the columns ``also``; null texts
    count as empty (0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fps.view(np.int64))], ["doc_id", *also, "fp"])

    d = docs.select(text_of().alias("text"), "doc_id", *also)
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields[1:])
    return d.mapInArrow(run, f"{kept}, fp long")


# ---------------------------------------------------------------- grid join
def _unary(fp: Column) -> Column:
    high = F.shiftrightunsigned(fp, 1)
    either = fp.bitwiseOR(high).bitwiseAND(F.lit(ODD))
    both = fp.bitwiseAND(high).bitwiseAND(F.lit(ODD))
    return either.bitwiseOR(F.shiftleft(both, 1))


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def grid_cells(fps: DataFrame) -> DataFrame:
    """(``band``, ``cell``, ``fp``, ``home``): the own cell of each band (home) and, in
    the first two, the cells one count higher."""
    u = F.col("_u")
    rows = []
    for band, mask in enumerate(BANDS):
        own = u.bitwiseAND(F.lit(_signed(mask)))
        rows.append(F.struct(F.lit(band).alias("band"), own.alias("cell"), F.lit(True).alias("home")))
        if band == 2:
            continue
        for s in range(11):
            low, top = 1 << (22 * band + 2 * s), 2 << (22 * band + 2 * s)
            up = F.when(own.bitwiseAND(F.lit(low)) == 0, own.bitwiseOR(F.lit(low))).when(
                own.bitwiseAND(F.lit(top)) == 0, own.bitwiseOR(F.lit(top)))
            rows.append(F.when(up.isNotNull(), F.struct(F.lit(band).alias("band"), up.alias("cell"),
                                                        F.lit(False).alias("home"))))
    return (fps.withColumn("_u", _unary(F.col("fp")))
            .select("fp", F.explode(F.array_compact(F.array(*rows))).alias("_c"))
            .select("_c.band", "_c.cell", "fp", "_c.home"))


def _forest(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the components of the links a-b (indices into ``fp``):
    (member, lowest fingerprint of its component) of all but the lowest."""
    label = np.arange(len(fp))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(fp)))
    return fp[at], fp[label[at]]


def _links(fp: np.ndarray, start: np.ndarray, home: np.ndarray, max_bits: int):
    """Linked index pairs of rows that share a group (``start`` marks where groups
    begin; home rows come first in each): every row against the home rows of its group."""
    n = len(fp)
    group = np.cumsum(start) - 1
    first = np.flatnonzero(start)
    homes = np.add.reduceat(home.astype(np.int64), first)[group]
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    # Home rows meet the home rows after them, the others all home rows.
    low = np.where(home, np.arange(n) + 1, first[group])
    many = np.maximum(first[group] + homes - low, 0)
    done = np.concatenate(([0], np.cumsum(many)))
    unary = _unary_np(fp)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(done, done[at] + PAIR_STEP, "right")) - 1)
        m = many[at:to]
        i = np.repeat(np.arange(at, to), m)
        j = np.arange(len(i)) - np.repeat(done[at:to] - done[at], m) + np.repeat(low[at:to], m)
        near = np.bitwise_count(unary[i] ^ unary[j]) <= max_bits
        i, j = i[near], j[near]
        exact = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        left.append(i[exact])
        right.append(j[exact])
        at = to
    return np.concatenate(left), np.concatenate(right)


def _unary_np(fp: np.ndarray) -> np.ndarray:
    odd, one = np.uint64(ODD), np.uint64(1)
    return ((fp | (fp >> one)) & odd) | (((fp & (fp >> one)) & odd) << one)


def link_forest(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(``a``, ``b``): links between distinct fingerprints ``fp`` whose components are
    those of all pairs within ``max_bits`` (at most 4, which the bands rest on)."""
    if max_bits > 4:
        raise ValueError("the bands cover at most 4 differing bits")
    spark = fps.sparkSession
    cells = written(spark, grid_cells(fps), "simhash_cells")
    big = (cells.groupBy("band", "cell").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
           .withColumn("_blocks", F.ceil(F.col("_n") / F.lit(block)).cast("int")))
    # A row of a big cell goes to every pair of its own block with another one.
    d = cells.join(big.select("band", "cell", "_blocks"), ["band", "cell"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("_blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: F.struct(
        F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    single = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    d = d.withColumn("_pair", F.explode(F.when(F.col("_blocks").isNull(), single).otherwise(pairs)))
    d = d.select("band", "cell", F.col("_pair.x").alias("x"), F.col("_pair.y").alias("y"), "fp", "home")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in _with_end(batches):
            if b is not None:
                cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
                held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
                if len(held[0]) < 50_000:
                    continue
            if held is None or not len(held[0]):
                continue
            keys = held[:4]
            new = np.ones(len(keys[0]), bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            cut = len(new) if b is None else int(np.flatnonzero(new)[-1])  # the last group may go on
            if cut:
                fp = held[4][:cut].astype(np.int64).view(np.uint64)
                i, j = _links(fp, new[:cut], held[5][:cut].astype(bool), max_bits)
                m, r = _local_forest(fp, i, j)
                yield pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(r.view(np.int64))], ["a", "b"])
                held = [c[cut:] for c in held]

    keys = ["band", "cell", "x", "y"]
    grouped = d.repartition(*keys).sortWithinPartitions(*keys, F.col("home").desc())
    return grouped.mapInArrow(run, "a long, b long").distinct()


def _with_end(batches):
    yield from batches
    yield None


def _local_forest(fp: np.ndarray, i: np.ndarray, j: np.ndarray):
    ids, at = np.unique(fp[np.concatenate((i, j))], return_inverse=True)
    if not len(ids):
        return ids, ids
    return _forest(ids, at[:len(i)], at[len(i):])


# ---------------------------------------------------------------- components
def components(links: DataFrame) -> DataFrame:
    """(``fp``, ``root``) for every end of a link: the lowest fingerprint of its
    connected component. Rounds of lowest-neighbour labels and pointer jumping over
    tables in the shared folder; a round at least halves long chains."""
    spark = links.sparkSession
    both = written(spark, links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                   "simhash_links")
    label = written(spark, both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "simhash_labels")
    while True:
        near = (both.join(label.select(F.col("a").alias("b"), F.col("root").alias("r")), "b")
                .groupBy("a").agg(F.min("r").alias("r")))
        # The label's own label as well: a chain of labels shortens by half.
        hop = label.select(F.col("a").alias("root"), F.col("root").alias("hop"))
        new = (label.join(near, "a").join(hop, "root", "left")
               .select("a", F.least("root", "r", "hop").alias("to"), F.col("root").alias("was")))
        new = written(spark, new, "simhash_labels")
        changed = bool(new.where("to <> was").head(1))
        label = new.select("a", F.col("to").alias("root"))
        if not changed:
            return label.withColumnRenamed("a", "fp")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and white-space texts have fingerprint zero and link like any other;
    texts of fewer words than a shingle hash the whole sequence. Repeated rows link as
    equal fingerprints. component_id is null where all ids of a component are null.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = written(spark, fingerprints(docs, shingle), "simhash_fps")
    named = _named(rows, F.col("doc_id"), max_bits)
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = named.join(ids, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(rows: DataFrame, least: Column, max_bits: int) -> DataFrame:
    """(``fp``, ``root``, ``first``): each distinct fingerprint, its component and the
    smallest ``least`` of its rows."""
    first = written(rows.sparkSession, rows.groupBy("fp").agg(F.min(least).alias("first")), "simhash_distinct")
    roots = components(link_forest(first.select("fp"), max_bits))
    return first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (a null id comes
    last; any one row of a repeated id); columns as they were. Rows are told apart by a
    number that is stored with them, so components may share ids or have none."""
    spark = docs.sparkSession
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    stored = written(spark, docs.select(whole.alias("_doc"), F.monotonically_increasing_id().alias("_row")), "simhash_docs")
    texts = stored.select("_row", F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.text").alias("text"))
    rows = written(spark, fingerprints(texts, shingle, ("_row",)), "simhash_fps")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_row"))
    keep = _named(rows, order, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    keep = written(spark, keep.select(F.col("first._row").alias("_row")), "simhash_keep")
    return stored.join(keep, "_row", "left_semi").select("_doc.*")
