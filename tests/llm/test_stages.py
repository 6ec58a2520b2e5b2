"""Copies in hot groups, columns with clashing names, the character model and the decoder
against brute force, and the memory of a task."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.llm import exact_dedup, packing, toxicity

WIDE = ("doc_id long, text string, _n string, _digest string, _size string, _rank string, _keep_id string, "
        "_row string, _doc string, _kept string, _w string, _shard string, _top string")


def wide(i, text):
    return (i, text, *[f"{c}{i}" for c in "abcdefghijk"])


@pytest.mark.parametrize("heavy_min", [2, 64])
def test_drop_exact_copies_leaves_columns_alone(spark, heavy_min):
    rows = [wide(i, t) for i, t in enumerate(["a b", "ab", "c", None, " ", "d"] * 60)] + [wide(None, "e f"), wide(None, "ef")]
    kept = exact_dedup.drop_exact_copies(spark.createDataFrame(rows, WIDE).repartition(5), heavy_min)
    assert kept.columns == [c.split()[0] for c in WIDE.split(", ")]
    want = {tuple(rows[i]) for i in (0, 2, 4, 5)} | {tuple(rows[-2])}
    assert Counter(map(tuple, kept.collect())) == Counter(want)


def test_one_row_a_hundred_thousand_times(spark):
    many = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    docs = many.union(spark.createDataFrame([(7, "other")], "doc_id long, text string")).repartition(6)
    got = exact_dedup.exact_groups(docs)
    assert got.where("kept").count() == 2 and got.agg(F.max("group_size")).first()[0] == 100_000
    assert exact_dedup.drop_exact_copies(docs).count() == 2
    frequent, rest = got._jdf.queryExecution().optimizedPlan().toString().split("\n+- ", 1)
    assert "Window" not in frequent and "Window" in rest     # rows of a frequent digest meet no window


def test_trigrams_against_a_plain_count():
    rng = random.Random(6)
    chars = "abzé漢ß.,'\"!*-_ \t\n0 A\u00a0\u0301"
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 60))) for _ in range(300)] + ["", "x" * 50]
    want = Counter()
    for t in texts:
        for w in t.lower().split():
            w = w.strip(toxicity._EDGE)
            if w.isalpha():
                c = toxicity._codes(w)
                for a, b, d in zip(c, c[1:], c[2:]):
                    want[(a * toxicity.ALPHABET + b) * toxicity.ALPHABET + d] += 1
    table, kinds = np.zeros(toxicity.ALPHABET ** 3, np.int64), toxicity.CharKinds()
    for t in toxicity._stretches(iter(texts)):
        toxicity.add_trigrams(table, t, kinds)
    assert {int(i): int(table[i]) for i in np.flatnonzero(table)} == dict(want)


def test_stretches_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 20)
    texts = ["ab cd " * 30, "", "x" * 70, "y z"]
    got = list(toxicity._stretches(iter(texts)))
    assert [w for t in got for w in t.split()] == [w for t in texts for w in t.split()]
    assert len(got) > 5


def spelled_cost(path, model):
    """Cost of a lattice path: channel prices and the character model over its letters."""
    a = b = 0
    cost = sum(price for _, price in path)
    for ch in "".join(letters for letters, _ in path):
        z = 0 if ch == " " else toxicity._CODE.get(ch, toxicity.ALPHABET - 1)
        if z or b:
            cost -= model[a, b, z]
            a, b = (b, z) if z else (0, 0)
    return cost - (model[a, b, 0] if b else 0.0)


def test_viterbi_against_all_paths():
    rng = random.Random(9)
    counts = Counter()
    for w in ["moron", "idiot", "stupid", "stool", "book", "letter", "toon", "sit"] * 3:
        c = toxicity._codes(w)
        for a, b, d in zip(c, c[1:], c[2:]):
            counts[(a * toxicity.ALPHABET + b) * toxicity.ALPHABET + d] += rng.randint(1, 40)
    model = toxicity.log_model(list(counts.items()))
    tokens = ["m0r0n", "1d10t", "s.t.u.p.i.d", "mo-ron", "b00k", "l3tt3r", "st00l", "$i7", "m0-r0n", "tooon", "i.d*ot"]
    tokens += ["".join(rng.choices("ost013.-*", k=6)) for _ in range(60)]
    for tok in tokens:
        arcs = toxicity.lattice(tok)
        costs = {}
        for path in itertools.product(*arcs):
            word = " ".join("".join(letters for letters, _ in path).split())
            costs[word] = min(costs.get(word, np.inf), spelled_cost(path, model))
        got = " ".join(toxicity.viterbi(tok, model).split())
        assert costs[got] == pytest.approx(min(costs.values()), abs=1e-9)


def test_doubled_letters_read_as_the_decoder_reads_them():
    rng = random.Random(12)
    counts = Counter()
    for w in ["book", "tool", "moron", "idiot", "letter", "too", "sit", "bot"] * 2:
        c = toxicity._codes(w)
        for a, b, d in zip(c, c[1:], c[2:]):
            counts[(a * toxicity.ALPHABET + b) * toxicity.ALPHABET + d] += rng.randint(1, 300)
    model = toxicity.log_model(list(counts.items()))
    words = {"".join(rng.choices("bokmritdle", k=rng.randint(2, 8))) for _ in range(4000)} | {"mooron", "iddiot", "book"}
    words = [w for w in words if toxicity._DOUBLE.search(w) and not toxicity._TRIPLE.search(w)]
    got = {w: toxicity.reading(w, model) for w in words}
    for w in words:
        codes = toxicity._codes(w)
        gains = [toxicity.double_gain(codes, m.start() + 2, model) for m in toxicity._DOUBLE.finditer(w)]
        assert got[w] == (toxicity.viterbi(w, model) if max(gains) >= toxicity.UNDOUBLE / 2 else w)
    assert got["mooron"] == "moron" and got["book"] == "book" and sum(w != r for w, r in got.items()) > 20


def test_null_and_empty_texts_score_alike_and_rows_repeat(spark):
    bad, good = "you vile skunk", "a fine day out"
    rows = [(i, (bad if i % 2 else good) + f" w{i}") for i in range(200)] + [(1000, None), (1001, ""), (1002, " \n"), (3, bad + " w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["score"], r["predicted"]))
    assert by[1000] == by[1001] == by[1002] and by[1000][0][1] == 0 and 0 <= by[1000][0][0] < 0.3
    assert len(by[3]) == 2 and by[3][0] == by[3][1] and by[3][0][1] == 1


def test_readings_are_forgotten_without_changing_scores(monkeypatch):
    model = toxicity.ToxicityModel(toxicity.log_model([]), {"=skunk": 2.0, "vil": 1.0}, np.ones(5))
    texts = [f"vile word{i} skunk sk.unk" for i in range(50)]
    want = [model.score(t) for t in texts]
    monkeypatch.setattr(toxicity, "CACHE", 3)
    model.forget()
    assert [model.score(t) for t in texts] == want


def test_piece_memory_is_bounded_and_cleared(monkeypatch):
    pieces = packing.known_pieces(packing.TOKENIZER)
    texts = ["alpha beta, gamma's 42", "alpha zeta é 漢字 x", "", "beta|beta"]
    want = [pieces.tok.encode(t, add_special_tokens=False).ids + [packing.END_ID] for t in texts]
    assert [x.tolist() for x in pieces.encode(texts)] == want
    monkeypatch.setattr(packing, "CACHE_BYTES", 1)
    assert [x.tolist() for t in texts for x in pieces.encode([t])] == want and pieces.bytes < 10_000
    pieces.clear()
    assert not pieces.at and pieces.bytes == 0 and packing.known_pieces(packing.TOKENIZER) is pieces


def test_maintained_totals_hold_every_document(spark):
    import re

    from txrisk.llm import rollups
    rows = [(i, f"word{i} a-b 12", f"s{i % 3}" if i % 5 else None, "en" if i % 2 else None) for i in range(60)]
    rows += [rows[3], rows[3], (None, "x y", None, None), (None, None, "s1", "en"), (70, "", "s1", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("n_docs", F.lit("z"))
    want = Counter()
    for _, t, s, g in rows:
        want[s, g, "docs"] += 1
        want[s, g, "tokens"] += len(re.findall(rollups.VERSIONS["words-2"], t or ""))
    got = rollups.maintained_totals(docs).collect()
    assert {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in got} == {
        (s, g): (n, want[s, g, "tokens"]) for (s, g, k), n in want.items() if k == "docs"}
    assert {r["tokenizer"] for r in got} == {"words-2"}
    assert rollups.maintained_totals(docs.limit(0)).count() == 0
