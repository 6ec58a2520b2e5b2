"""Toxicity by noisy-channel deobfuscation.

A token that a writer may have disguised (letters replaced by digits or symbols, a
letter repeated three times or more or doubled where the character model expects it
once, anything between letters) is a lattice: every symbol lists the letters it may
stand for, a repetition may be one or two letters, a separator may be nothing or a word
break. Viterbi decoding under a character trigram model takes the most likely reading.
Tokens without such signs have one path, themselves, and skip the decoder.

Restored words are scored by the evidence of their stems (prefixes of 3 to 6 letters)
and full forms: the lower confidence bound of the log odds of toxic against clean
documents. A small logistic model turns a document's strongest evidence into a score.

The character model counts trigrams over all documents. The labels used are a sample
of at most ``LABELLED_ROWS`` rows (those whose ids hash lowest), which bounds
everything that reaches the driver: the character table has at most ``ALPHABET``
cubed rows, the evidence table the stems of that sample that speak for a toxic text.
Labels, language, source and id are never inputs of a score.

A token of any length is decoded whole (time and memory grow with its length). A text
without tokens has no evidence and gets the score of that; a null text counts as empty.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from txrisk.llm.common import give_back, text_of, written

LABELLED_ROWS = 20_000
CUT = 0.3
STEMS = (3, 4, 5, 6)
CACHE = 300_000      # tokens a task remembers
CACHE_CHARS = 16 << 20   # and their characters
PIECE = 1 << 20      # characters counted at once
HIT = 1.5

#: Letters a symbol may stand for (fixed values).
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "*": "aeiou"}
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
ALPHABET = len(LETTERS) + 2          # word boundary 0, any other letter last
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_EDGE = ".,;:?\"'()[]{}<>=~^`/\\%&#"
_TAIL = _EDGE + "!*$|+@-_"
_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"([^\W\d_])\1")
_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1*", re.S)
_GAP = re.compile(r"\s+")
SUBSTITUTE, COLLAPSE, JOIN, BREAK = 0.7, 0.5, 0.2, 1.0   # channel costs, nats
UNDOUBLE = 4 * COLLAPSE


def held_out(doc_id: Column) -> Column:
    return _bucket(doc_id) == 2


def _bucket(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


# ---------------------------------------------------------------- character model
def _codes(word: str) -> list[int]:
    other = ALPHABET - 1
    return [0, 0, *[_CODE.get(c, other) for c in word], 0]


class CharKinds:
    """Letter code and kind (letter, edge, space, other) of every character met so far."""

    LETTER, EDGE, SPACE, OTHER, NEW = range(5)

    def __init__(self):
        self.code = np.zeros(0x110000, np.int64)
        self.kind = np.full(0x110000, self.NEW, np.uint8)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        kind = self.kind[at]
        if (kind == self.NEW).any():
            for p in np.unique(at[kind == self.NEW]).tolist():
                c = chr(p)
                self.kind[p] = (self.LETTER if c.isalpha() else self.SPACE if c.isspace()
                                else self.EDGE if c in _EDGE else self.OTHER)
                self.code[p] = _CODE.get(c, ALPHABET - 1) if c.isalpha() else 0
            kind = self.kind[at]
        return self.code[at], kind


def add_trigrams(table: np.ndarray, text: str, kinds: CharKinds) -> None:
    """Count the trigrams of a text's plain words: tokens that are one run of letters
    once edge characters are gone."""
    code, kind = kinds.of(f"\n\n{text.lower()}\n")
    letter, space = kind == kinds.LETTER, kind == kinds.SPACE
    token = np.cumsum(~space & np.concatenate(([True], space[:-1])))
    first = letter & ~np.concatenate(([False], letter[:-1]))
    runs = np.bincount(token[first], minlength=int(token[-1]) + 1)
    odd = np.bincount(token[kind == kinds.OTHER], minlength=len(runs))
    plain = letter & ((runs == 1) & (odd == 0))[token]
    code = np.where(plain, code, 0)
    at = np.flatnonzero(plain)
    last = code[at - 1]
    before = np.where(last == 0, 0, code[at - 2])
    end = at[~plain[at + 1]]
    table += np.bincount((before * ALPHABET + last) * ALPHABET + code[at], minlength=len(table))
    table += np.bincount((code[end - 1] * ALPHABET + code[end]) * ALPHABET, minlength=len(table))


def _stretches(texts: Iterator[str]) -> Iterator[str]:
    """The texts in stretches of about ``PIECE`` characters, cut at white space."""
    held, size = [], 0
    for t in texts:
        at = 0
        while len(t) - at > PIECE:
            cut = _GAP.search(t, at + PIECE)
            if not cut:
                break
            yield t[at:cut.start()]
            at = cut.end()
        held.append(t[at:])
        size += len(t) - at
        if size > PIECE:
            yield "\n".join(held)
            held, size = [], 0
    yield "\n".join(held)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(``t``, ``n``): trigrams of the plain words of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, kinds = np.zeros(ALPHABET ** 3, np.int64), CharKinds()
        for stretch in _stretches(t for b in batches for t in b.column(0).to_pylist()):
            add_trigrams(table, stretch, kinds)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(table[at])], ["t", "n"])
        give_back()

    return (docs.select(text_of().alias("text")).mapInArrow(run, "t long, n long")
            .groupBy("t").agg(F.sum("n").alias("n")))


def log_model(counts: list[tuple[int, int]]) -> np.ndarray:
    """Interpolated trigram log probabilities [before last, last, next]."""
    n = np.zeros(ALPHABET ** 3)
    for t, c in counts:
        n[t] = c
    n = n.reshape(ALPHABET, ALPHABET, ALPHABET)
    one = (n.sum((0, 1)) + 0.5) / (n.sum() + 0.5 * ALPHABET)
    pair = n.sum(0)
    two = (pair + 20 * one) / (pair.sum(1, keepdims=True) + 20)
    three = (n + 20 * two[None]) / (n.sum(2, keepdims=True) + 20)
    return np.log(three)


# ---------------------------------------------------------------- lattice
def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Arcs per run of equal characters: (letters, cost). ' ' is a word break."""
    runs = [m[0] for m in _RUN.finditer(token)]
    letters = [len(r) if r[0].isalpha() or r[0] in LEET else 0 for r in runs]
    arcs = []
    for k, r in enumerate(runs):
        c = r[0]
        if c.isalpha():
            arcs.append([(r, 0.0)] if len(r) == 1 else [(c, UNDOUBLE if len(r) == 2 else COLLAPSE),
                                                        (c + c, 0.0 if len(r) == 2 else COLLAPSE)])
        elif c in LEET and 0 < k < len(runs) - (c in "!*|") or c in LEET and c not in "!*|":
            arcs.append([(x * m, SUBSTITUTE + COLLAPSE * (m != len(r))) for x in LEET[c] for m in {1, min(2, len(r))}])
        elif c in "0123456789":
            arcs.append([(" ", BREAK)])
        else:
            single = any(0 <= j < len(runs) and letters[j] and _piece(runs, letters, j) == 1 for j in (k - 1, k + 1))
            arcs.append([("", JOIN), (" ", BREAK if single else 0.0)])
    return arcs


def _piece(runs: list[str], letters: list[int], j: int) -> int:
    """Runs in the unbroken piece around ``j``."""
    a = b = j
    while a > 0 and letters[a - 1]:
        a -= 1
    while b + 1 < len(runs) and letters[b + 1]:
        b += 1
    return b - a + 1


def viterbi(token: str, model: np.ndarray) -> str:
    """Most likely reading of a token: cheapest path through its lattice."""
    other = ALPHABET - 1
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for arcs in lattice(token):
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in best.items():
            for letters, price in arcs:
                x, y, c = a, b, cost + price
                for ch in letters:
                    z = 0 if ch == " " else _CODE.get(ch, other)
                    if z or y:
                        c -= model[x, y, z]
                        x, y = (y, z) if z else (0, 0)
                if (x, y) not in new or c < new[x, y][0]:
                    new[x, y] = (c, (path, letters))
        best = new
    cost = {s: c - (model[s[0], s[1], 0] if s[1] else 0.0) for s, (c, _) in best.items()}
    path, out = best[min(cost, key=cost.get)][1], []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out)).strip()


def double_gain(codes: list[int], k: int, model: np.ndarray) -> float:
    """What the character model gains where the letter at ``k``, which its neighbour
    repeats, is read once. The reading costs ``UNDOUBLE``; beside no other choice, that
    decides the best path."""
    a, c, d, e = codes[k - 1], codes[k], codes[k + 1], codes[k + 2]
    return model[a, c, e] - model[a, c, d] - model[c, d, e]


def undoubled(word: str, model: np.ndarray) -> str:
    """The most likely reading of a word whose only signs are doubled letters, none of
    which enters the lattice unless reading one once gains at least half of its cost."""
    at = [m.start() for m in _DOUBLE.finditer(word)]
    codes = _codes(word)
    gains = [double_gain(codes, k + 2, model) for k in at]   # after two boundaries
    if not gains or max(gains) < UNDOUBLE / 2:
        return word
    if len(at) > 1:
        return viterbi(word, model)
    return word[:at[0]] + word[at[0] + 1:] if gains[0] >= UNDOUBLE else word


def reading(tok: str, model: np.ndarray) -> str:
    """A token's words after deobfuscation, joined by spaces."""
    bare = tok.lstrip(_EDGE).rstrip(_TAIL)
    if bare.isalpha():
        if not _DOUBLE.search(bare):
            return bare
        return undoubled(bare, model) if not _TRIPLE.search(bare) else viterbi(bare, model)
    pieces = _WORD.findall(bare)
    if not pieces:
        return ""
    if len(pieces) > 1 or _TRIPLE.search(bare) or any(c in LEET for c in bare):
        return " ".join(viterbi(bare, model).split())
    return undoubled(pieces[0], model)


def tokens(text: str) -> set[str]:
    """The distinct tokens of a text. Three or more single letters in a row are also one
    spaced token."""
    toks = text.lower().split()
    if not toks:
        return set()
    one = np.fromiter(map(len, toks), np.int64, len(toks)) == 1
    out = set(toks)
    if one.sum() >= 3:
        edge = np.flatnonzero(np.diff(np.concatenate(([0], one, [0]))))
        out.update(" ".join(toks[a:b]) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= 3)
    return out


class Readings(dict):
    """Token -> its reading. ``new`` is called with a token's reading when it comes first;
    everything is forgotten between texts once it passes the bounds."""

    def __init__(self, model: np.ndarray, new):
        super().__init__()
        self.model, self.new, self.chars = model, new, 0

    def __missing__(self, tok: str) -> str:
        words = reading(tok, self.model)
        self.new(words)
        self.chars += len(tok)
        self[tok] = words
        return words

    def of(self, text: str) -> set[str]:
        return set(map(self.__getitem__, tokens(text)))

    def full(self) -> bool:
        return len(self) > CACHE or self.chars > CACHE_CHARS


def stems(word: str) -> list[str]:
    """Full form (marked) and stems of a word."""
    return [f"={word}", *[word[:k] for k in STEMS if len(word) > k]]


# ---------------------------------------------------------------- training
class ToxicityModel:
    """Character model, stem evidence and the logistic weights."""

    def __init__(self, chars: np.ndarray, evidence: dict[str, float], weights: np.ndarray):
        self.chars, self.evidence, self.weights = chars, evidence, weights
        self.heads = {s[:STEMS[0]] for s in evidence if s[0] != "="}
        self.readings, self.worth = None, {}

    def __getstate__(self):
        return {**self.__dict__, "readings": None, "worth": {}}

    def _weigh(self, words: str) -> None:
        get, v = self.evidence.get, 0.0
        for w in words.split():
            v = max(v, get("=" + w, 0.0))
            if w[:STEMS[0]] in self.heads:
                v = max(v, *[get(s, 0.0) for s in stems(w)])
        if v > 0:
            self.worth[words] = v

    def forget(self) -> None:
        self.readings, self.worth = None, {}

    def features(self, text: str) -> list[float]:
        """Bias, strongest and second evidence, number of strong words, length."""
        if self.readings is None or self.readings.full():
            self.forget()
            self.readings = Readings(self.chars, self._weigh)
        found = self.readings.of(text)
        top = sorted((self.worth[w] for w in found & self.worth.keys()), reverse=True)
        return [1.0, top[0] if top else 0.0, top[1] if len(top) > 1 else 0.0,
                math.log1p(sum(v > HIT for v in top)), math.log1p(len(found)) / 8]

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, self.features(text)), -30, 30))))


def _bound(folds: tuple[str, ...], totals: dict[str, int]) -> Column:
    """Lower confidence bound (95 %) of a stem's log odds."""
    pos, neg = (math.log(sum(totals[f"{f}{t}"] for f in folds) + 1.0) for t in (1, 0))
    a, b = (sum((F.col(f"{f}{t}") for f in folds), F.lit(0.5)) for t in (1, 0))
    return F.log(a) - pos - F.log(b) + neg - 1.64 * F.sqrt(1 / a + 1 / b)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Newton's method with a ridge on all weights but the bias."""
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(w)), x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Fit on the labelled rows that are not held out. Rows with a null label or id are
    left out, as are labels without a document; of repeated labels of an id one counts.
    Without labels of both kinds the score is the share of toxic labels (0 without any)."""
    spark = docs.sparkSession
    chars = log_model([(r[0], r[1]) for r in trigram_counts(docs).collect()])  # at most ALPHABET^3 rows
    sample = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows))
    rows = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")
            .select((F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string")).cast("binary")) % 2).cast("int").alias("fold"),
                    "toxic", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Readings(chars, lambda words: None)
        for b in batches:
            got = []
            for t in b.column(2).to_pylist():
                got.append(sorted({s for words in known.of(t) for w in words.split() for s in stems(w)}))
                if known.full():
                    known = Readings(chars, known.new)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.list_(pa.string()))],
                                             ["fold", "toxic", "stems"])
        known.clear()
        give_back()

    kind = lambda f, t: (F.col("fold") == f) & (F.col("toxic") == t)
    names = {"a0": (0, 0), "a1": (0, 1), "b0": (1, 0), "b1": (1, 1)}
    read = written(spark, rows.mapInArrow(run, "fold int, toxic int, stems array<string>"), "toxic_stems")
    totals = read.agg(*[F.count(F.when(kind(*v), 1)).alias(k) for k, v in names.items()]).head().asDict()
    n_pos, n = totals["a1"] + totals["b1"], sum(totals.values())
    if not n_pos or n_pos == n:
        share = n_pos / n if n else 0.0
        odds = math.log((share + 1e-9) / (1 - share + 1e-9))
        return ToxicityModel(chars, {}, np.array([odds, 0, 0, 0, 0.0]))
    table = (read.select("fold", "toxic", F.explode("stems").alias("s")).groupBy("s")
             .agg(*[F.count(F.when(kind(*v), 1)).alias(k) for k, v in names.items()])
             .where("a1 + b1 >= 2").select("s", _bound(("a",), totals).alias("half"), _bound(("a", "b"), totals).alias("every"))
             .where("half > 0 or every > 0").collect())      # stems of at most labelled_rows rows
    half, every = ({r["s"]: r[k] for r in table if r[k] > 0} for k in ("half", "every"))

    # The logistic weights come from the fold whose labels the evidence has not seen.
    half_model = ToxicityModel(chars, half, np.zeros(5))
    seen = rows.where("fold = 1").select("toxic", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [half_model.features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])
        half_model.forget()
        give_back()

    got = seen.mapInArrow(features, "toxic int, x array<double>").collect()  # at most labelled_rows rows
    x, y = np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], float)
    return ToxicityModel(chars, every, _logistic(x, (y > 0).astype(float)) if len(got) else np.zeros(5))


def add_scores(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` (with a string column ``text``; null counts as empty) plus the score in
    column ``name``, which must be free. Other columns pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores = [m.score(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, name])
        m.forget()  # the worker lives on, its memory is the next task's
        give_back()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted. Repeated rows
    give repeated results, an empty table an empty one."""
    scored = add_scores(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns as they were."""
    return add_scores(docs, train(docs, labels), "_toxicity").where(F.col("_toxicity") < CUT).drop("_toxicity")
