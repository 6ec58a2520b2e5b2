"""Conversation repair by a Viterbi that runs in chunks until its cost vectors converge.

Rows of a conversation are kept, given another role, deleted, or preceded by inserted
empty turns, at least cost, so that the roles read system?, (user, assistant)*. The state
after a row is what the roles so far end in. A backward pass gives the least cost to go
from every state; the trace then walks forward and takes at each step the ASCII-least
edit that stays on a cheapest path, which gives the least audit string.

A conversation may hold any share of all rows, so the pass runs in chunks of at most
``2 ** CHUNK_BITS`` rows at once. Only the last chunk knows its final costs; the others
start from a speculative vector. In a fix-up pass a chunk whose start turns out not to be
parallel to (differ by a constant from) the vector that the chunk after it has reached is
rerun from that one beside its old run, until the two vectors differ by a constant only:
from there on the old run is right but for that constant. Passes go on while a
chunk changes; after ``FIX_PASSES`` of them (long stretches of rows that must be deleted never
converge) the remaining chunks are rerun from right to left in one stream. Summing the
constants gives the conversation's cost. Each chunk is traced from every state it may be
entered in, and the stream that writes the repaired rows picks the trace.

The order of rows is settled once by a range sort (conversation, turn, role, text) whose row
numbers all later steps use; text passes one more exchange, to the conversation's stream. That
stream holds one state, not the conversation: memory does not grow with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.llm.common import written

CHUNK_BITS = 12
FIX_PASSES = 6
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States: what the repaired roles end in. 0 nothing, 1 system, 2 user, 3 assistant (0 and 3 may end).
STATES = 4
TURN = (2, 2, 3, 2)                     # state after the only user/assistant turn that may follow
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
ROLE = {2: "user", 3: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)        # cost to end from each state
GUESS = (0,) * STATES                   # speculative start
LEGAL = ("su", "ua", "au")

#: Row kinds: s, u, a, x (another role), in capitals if truncated; B blank and R repeated rows must go.
MUST_GO = "BR"


def steps(kind: str, state: int, after: tuple) -> list[tuple[str, int, int]]:
    """Ways past a row: (edit, cost to go, state), ASCII order; without insertions before it."""
    out = [("D", DELETE + after[state], state)]
    if kind not in MUST_GO:
        extra = TRUNCATED if kind.isupper() else 0
        kept = KEEP[kind.lower()][state]
        if kept is not None:
            out.append(("K", extra + after[kept], kept))
        out.append(("R", RELABEL + extra + after[TURN[state]], TURN[state]))
    return out


def closed(costs: list[int]) -> list[int]:
    """With the turns that may be inserted first."""
    out = list(costs)
    out[2] = min(out[2], INSERT + out[3])
    out[3] = min(out[3], INSERT + out[2])
    out[0], out[1] = min(out[0], INSERT + out[2]), min(out[1], INSERT + out[2])
    return out


@lru_cache(maxsize=100_000)
def back(kind: str, after: tuple) -> tuple[tuple, int]:
    """The cost vector before a row from that after it, as a vector with minimum 0 and a constant."""
    costs = closed([min(c for _, c, _ in steps(kind, q, after)) for q in range(STATES)])
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=100_000)
def walk(kind: str, state: int, after: tuple) -> tuple[str, int]:
    """Edits of the least trace past a row (insertions before it included), and the state then."""
    here = closed([min(c for _, c, _ in steps(kind, q, after)) for q in range(STATES)])
    edits = ""
    while True:
        choice = [(e, q) for e, c, q in steps(kind, state, after) if c == here[state]]
        if INSERT + here[TURN[state]] == here[state]:
            choice.append(("I", TURN[state]))
        edit, state = min(choice)
        edits += edit
        if edit != "I":
            return edits, state


def flat(vector) -> tuple[tuple, int]:
    least = min(vector)
    return tuple(v - least for v in vector), least


def run_back(kinds: str, start) -> list[int]:
    """Cost vector before the first row, from that after the last one."""
    v, base = flat(start)
    for kind in reversed(kinds):
        v, c = back(kind, v)
        base += c
    return [x + base for x in v]


def rerun(kinds: str, old: list[int], reached: list[int], new: list[int]) -> tuple[list[int], int]:
    """Result from the start ``new``, given that ``old`` reached ``reached``; and the rows passed
    until both runs differed by a constant only."""
    (a, ca), (b, cb) = flat(new), flat(old)
    for i, kind in enumerate(reversed(kinds)):
        if a == b:
            return [x + ca - cb for x in reached], i
        (a, da), (b, db) = back(kind, a), back(kind, b)
        ca, cb = ca + da, cb + db
    return [x + ca for x in a], len(kinds)


def trace(kinds: str, start, state: int, last: bool) -> str:
    """Least edits through a chunk entered in ``state``, with the turns inserted at the very end."""
    after = [flat(start)[0]]
    for kind in reversed(kinds[1:]):
        after.append(back(kind, after[-1])[0])
    edits = []
    for kind in kinds:
        e, state = walk(kind, state, after.pop())
        edits.append(e)
    return "".join(edits) + "I" * (END[state] // INSERT if last else 0)


# ---------------------------------------------------------------- chunks
def lined_up(turns: DataFrame) -> DataFrame:
    """All rows with their place in a common order by (conversation, turn, role, text) and their kind but
    for repetition. Equal rows are spread by a seeded draw, the same again if a task is rerun."""
    spark = turns.sparkSession
    d = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                     F.coalesce("text", F.lit(" ")).alias("text"))
    order = ["conv_id", "turn", "role", "_text", "_draw"]
    d = (d.withColumn("_text", F.xxhash64("text")).withColumn("_draw", F.rand(12))
         .repartitionByRange(*order).sortWithinPartitions(*order).drop("_text", "_draw")
         .withColumn("pos", F.monotonically_increasing_id()))
    seen = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    kind = F.when(seen == "", "B").when(F.substring(seen, -1, 1).isin(".", "!", "?"), letter).otherwise(F.upper(letter))
    return written(spark, d.withColumn("kind", kind), "turns")


def chunks(lined: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, chunk, pos, kinds, nxt, first): at most 2 ** chunk_bits rows each; ``nxt`` is the
    conversation's next chunk. A first occurrence of (role, text) is marked by a narrow row of its own
    beside the row, so no join on a frequent text is needed."""
    chunk = F.expr(f"shiftright(pos, {chunk_bits})").alias("chunk")
    firsts = (lined.groupBy("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
              .agg(F.min("pos").alias("pos")).select("conv_id", "pos", F.lit("!").alias("kind")))
    marked = lined.select("conv_id", "pos", "kind").unionByName(firsts)
    line = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "kind"))), lambda r: r["kind"]), "")
    kinds = F.regexp_replace(F.regexp_replace(line, "(?<!!)[suaxSUAX]", "R"), "!", "")
    order = Window.partitionBy("conv_id").orderBy("chunk")
    return written(lined.sparkSession, marked.groupBy("conv_id", chunk)
                   .agg(F.min("pos").alias("pos"), kinds.alias("kinds"))
                   .withColumn("nxt", F.lead("chunk").over(order))
                   .withColumn("first", F.lag("chunk").over(order).isNull()), "turn_chunks")


def _map(df: DataFrame, fn, **new: str) -> DataFrame:
    """Add or replace columns by ``fn`` (a function of the row as a dict that returns them)."""
    kinds = {**dict(df.dtypes), **new}
    types = {"array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "int": pa.int32(),
             "bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fn(r) for r in b.to_pylist()]
            cols = {c: b[c] for c in b.schema.names}
            for c, kind in new.items():
                cols[c] = pa.array([g[c] for g in got], types[kind])
            yield pa.RecordBatch.from_pydict(cols)
    return df.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def parallel(a: str, b: str):
    """Whether two vector columns differ by a constant only."""
    return F.forall(F.zip_with(a, b, lambda x, y: x - y), lambda d: d == F.col(a)[0] - F.col(b)[0])


def converged(cut: DataFrame, fix_passes: int = FIX_PASSES) -> DataFrame:
    """Chunks with the vector they start from at their right end (``used``) and the one they reach at
    the left (``out``), both right but for a constant, and ``beyond``: the next chunk's ``out``."""
    spark = cut.sparkSession

    def start(r):
        used = list(END if r["nxt"] is None else GUESS)
        return {"used": used, "out": run_back(r["kinds"], used)}

    def fix(r):
        return {"used": r["beyond"], "out": rerun(r["kinds"], r["used"], r["out"], r["beyond"])[0]}

    vec = {"used": "array<bigint>", "out": "array<bigint>"}
    state = written(spark, _map(cut, start, **vec), "turn_costs")
    alone = F.col("first") & F.col("nxt").isNull()
    single = state.where(alone).withColumn("beyond", F.lit(None).cast("array<bigint>"))
    several = state.where(~alone)
    for p in range(fix_passes + 1):
        right = several.select(F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"), F.col("out").alias("beyond"))
        joined = several.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("nxt") == F.col("_chunk")),
                              "left").drop("_conv", "_chunk")
        joined = written(spark, joined, "turn_costs")
        wrong = F.col("beyond").isNotNull() & ~parallel("beyond", "used")
        if joined.where(wrong).isEmpty():
            break
        if p == fix_passes:
            joined = written(spark, _in_one_stream(joined), "turn_costs")
            break
        several = written(spark, _map(joined.where(wrong), fix, **vec)
                          .unionByName(joined.where(~wrong)).drop("beyond"), "turn_costs")
    return single.unionByName(joined)


def _in_one_stream(joined: DataFrame) -> DataFrame:
    """Chunks from right to left, each conversation in one stream; a chunk is rerun where it must be."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = None
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                if r["nxt"] is not None:
                    r["beyond"] = reached
                    if flat(reached)[0] != flat(r["used"])[0]:
                        r["out"], r["used"] = rerun(r["kinds"], r["used"], r["out"], reached)[0], reached
                reached = r["out"]
            yield pa.RecordBatch.from_pylist(rows, b.schema)
    return (joined.repartition("conv_id").sortWithinPartitions("conv_id", F.col("chunk").desc())
            .mapInArrow(run, joined.schema))


def traced(costs: DataFrame) -> DataFrame:
    """Chunks with their edits from every state they may be entered in, faults and share of the cost."""
    def run(r):
        states = (0,) if r["first"] else range(STATES)
        k = r["kinds"]
        const = r["beyond"][0] - r["used"][0] if r["nxt"] is not None else 0
        return {"edits": [trace(k, r["used"], q, r["nxt"] is None) for q in states],
                "counts": [k.count("B"), k.count("R"), sum(c.isupper() for c in k) - k.count("B") - k.count("R"),
                           const + (r["out"][0] if r["first"] else 0)]}
    return _map(costs, run, edits="array<string>", counts="array<bigint>").select("conv_id", "pos", "edits", "counts")


# ---------------------------------------------------------------- the repaired conversation
class _Open:
    """The conversation that a stream is in."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.edits, self.at = conv_id, 0, "", 0
        self.low = self.high = self.turn = self.initial = None
        self.turns = self.illegal = 0
        self.counts = [0, 0, 0, 0]

    def chunk(self, r) -> None:
        self.edits, self.at = r["edits"][self.state if len(r["edits"]) > 1 else 0], 0
        self.counts = [a + b for a, b in zip(self.counts, r["counts"])]

    def inserted(self) -> Iterator[tuple]:
        while self.edits[self.at:self.at + 1] == "I":
            self.at += 1
            self.state = TURN[self.state]
            yield (self.conv_id, "I", None, ROLE[self.state], "")

    def row(self, r) -> Iterator[tuple]:
        if r["turn"] is not None:
            self.turns += r["turn"] != self.turn
            self.turn = self.high = r["turn"]
            self.low = r["turn"] if self.low is None else self.low
        initial = r["role"][:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        yield from self.inserted()
        edit, role = self.edits[self.at], r["role"]
        self.at += 1
        if edit == "K":
            self.state = KEEP[initial][self.state]
        elif edit == "R":
            self.state = TURN[self.state]
            role = ROLE[self.state]
        yield (self.conv_id, edit, r["turn"], role, r["text"])

    def summary(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, None, None, None, None, [gaps, *self.counts[:3], self.illegal, self.counts[3]])


def repair(turns: DataFrame, conversations: DataFrame | None = None, chunk_bits: int = CHUNK_BITS,
           fix_passes: int = FIX_PASSES) -> DataFrame:
    """Edits of every conversation (conv_id, edit, turn, role, text, summary), each conversation's in order
    inside one partition: D, I, K and R rows with the repaired role and the text, then a row without an edit whose
    ``summary`` has [gaps, blank, duplicate, truncated, illegal, cost]. ``conversations`` adds ids without turns.

    A null conv_id is a conversation of its own; null turns come first; a null role or text counts as one
    space. Rows of one turn are ordered by role, then by a hash of the text; equal rows are interchangeable. A row
    that repeats an earlier role and text is a duplicate wherever it stands. An empty role starts with no
    letter: it can be relabelled or deleted, not kept, and makes its pairs illegal. An empty table gives no rows; other
    columns are not read. Turns are integers."""
    kinds = dict(turns.dtypes)
    lined = lined_up(turns)
    edits = traced(converged(chunks(lined, chunk_bits), fix_passes))
    ids = (turns if conversations is None else conversations).select("conv_id").distinct()
    rows = (ids.withColumn("pos", F.lit(-1).cast("long")).withColumn("part", F.lit(0))
            .unionByName(edits.withColumn("part", F.lit(1)), allowMissingColumns=True)
            .unionByName(lined.drop("kind").withColumn("part", F.lit(2)), allowMissingColumns=True))
    schema = pa.schema([("conv_id", pa.int64() if kinds["conv_id"] in ("bigint", "int") else pa.string()), ("edit", pa.string()),
                        ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("summary", pa.list_(pa.int64()))])
    ddl = (f"conv_id {'long' if kinds['conv_id'] in ('bigint', 'int') else 'string'}, edit string, turn long, role string, "
           "text string, summary array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def emit(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["part"] == 0 or now is None or r["conv_id"] != now.conv_id:
                    if now is not None:
                        out += [(*x, None) for x in now.inserted()]
                        out.append(now.summary())
                    now = _Open(r["conv_id"])
                if r["part"] == 1:
                    out += [(*x, None) for x in now.inserted()]
                    now.chunk(r)
                elif r["part"] == 2:
                    out += [(*x, None) for x in now.row(r)]
            if out:
                yield emit(out)
        if now is not None:
            yield emit([*[(*x, None) for x in now.inserted()], now.summary()])

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "part").mapInArrow(run, ddl)


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (the
    edits) and repaired_sha256 (the repaired ``role:text``, newline-joined). Reads the edits in their stream."""
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    id_kind = dict(edits.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, empty = [], hashlib.sha256(), True
        for b in batches:
            out = []
            for conv, edit, role, text, summary in zip(*(b[c].to_pylist() for c in (
                    "conv_id", "edit", "role", "text", "summary"))):
                if edit is None:
                    out.append([conv, *summary, "".join(audit), digest.hexdigest()])
                    audit, digest, empty = [], hashlib.sha256(), True
                    continue
                audit.append(edit)
                if edit != "D":
                    digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                    empty = False
            if out:
                kinds = [pa.int64() if id_kind == "bigint" else pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["conv_id", *names, "audit", "repaired_sha256"])

    return edits.mapInArrow(run, f"conv_id {id_kind}, {', '.join(f'{n} long' for n in names)}, "
                                 "audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage, by crc32(``conv_id:turn``) % 20 (nulls count as one space): 0 drops a row, 1 empties its text,
    2 removes its sentence ends, 3 repeats it, 4 sets the role to user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = (F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.regexp_replace(blank("text"), "[.!?]", ""))
            .otherwise(blank("text")))
    times = F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return (turns.select("conv_id", "turn", "role", "text").withColumn("_draw", draw).where("_draw != 0")
            .select("conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(blank("role")).alias("role"),
                    text.alias("text"), times.alias("_copy")).drop("_copy"))


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """Every conversation of ``turns`` after the damage: faults, cost, audit and hash of the repaired text."""
    return summaries(repair(damaged(turns), turns))
