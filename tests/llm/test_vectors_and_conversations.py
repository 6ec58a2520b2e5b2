"""Vector codes, exact top-k and conversation repair against brute force, with nulls, repeated rows,
ties, ragged vectors, columns with clashing names, and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from txrisk.llm import conversations, topk, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, x string, row long, code string, error string, rank int"
TURNS = "conv_id long, turn long, role string, text string, pos string, kind int, chunk int, edit string, summary int"


def vector_rows(n=130, width=16):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, width))
    rows = [(i, (centre[i % 6] + 0.3 * rng.normal(size=width)).astype(np.float32).tolist(), i % 4 if i % 9 else None)
            for i in range(n)]
    rows += [rows[7], rows[7], rows[100], (200, rows[50][1], 1), (None, rows[100][1], None), (None, rows[3][1], 2),
             (250, [0.0] * width, 3), (300, rows[1][1][:5], 3), (350, [], 0),
             (400, None, 0), (450, [*rows[2][1][:-1], None], 0), (500, [*rows[2][1][:-1], float("nan")], 0),
             (550, [*rows[2][1][:-1], float("inf")], 0)]
    return [(a, b, c, "x", 5, "c", "e", 1) for a, b, c in rows]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), VECTORS).repartition(5).cache()


def whole(rows, scale, width=16):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    x = np.zeros((len(kept), width), np.int64)
    for i, r in enumerate(kept):
        x[i, :len(r[1])] = np.floor(np.array(r[1], np.float64) * scale)
    return kept, x


def brute_codes(rows):
    kept, x = whole(rows, 4096)
    x = x.reshape(len(kept), 8, 2)
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, x[i].ravel().tolist()))[:16]
    book = x[first].swapaxes(0, 1).copy()
    for step in range(7):
        far = ((x[:, :, None, :] - book[None]) ** 2).sum(-1)
        code = far.argmin(-1)
        if step < 6:
            for p in range(8):
                for e in range(len(first)):
                    mine = x[code[:, p] == e, p]
                    if len(mine):
                        book[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    error = far.min(-1).sum(-1)
    totals = Counter()
    for r, e in zip(kept, error):
        totals[r[2]] += int(e)
    digest = hashlib.sha256(",".join(map(str, book.ravel())).encode()).hexdigest()
    return Counter((r[0], "".join(f"{c:02x}" for c in k), int(e), totals[r[2]], digest)
                   for r, k, e in zip(kept, code, error))


def test_vector_codes(spark, vectors):
    got = Counter(map(tuple, vector_codes.coded_rows(vectors).collect()))
    assert got == brute_codes(vector_rows())
    few = vector_rows()[:5]
    assert Counter(map(tuple, vector_codes.coded_rows(spark.createDataFrame(few, VECTORS)).collect())) == brute_codes(few)
    assert vector_codes.coded_rows(spark.createDataFrame([], VECTORS)).count() == 0
    with pytest.raises(ValueError):
        vector_codes.coded_rows(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>")
                                .withColumn("label", F.lit(1)))


def test_rare_and_frequent_labels(spark, monkeypatch):
    coded = spark.createDataFrame([(i, None if i % 3 == 0 else i % 40, i) for i in range(200)], "vec_id long, label int, error long")
    want = {r["vec_id"]: r["w"] for r in coded.selectExpr("vec_id", "sum(error) over (partition by label) as w").collect()}
    for share in (1000, 10, 2):
        monkeypatch.setattr(vector_codes, "HEAVY_SHARE", share)
        got = vector_codes.with_label_error(spark, coded).collect()
        assert {r["vec_id"]: r["label_error"] for r in got} == want and len(got) == 200


def test_net_bounds_hold_and_skip_more_than_drifts():
    rng = np.random.default_rng(5)
    centre = rng.integers(-4000, 4000, (16, 8, 8))
    x = centre[rng.integers(0, 16, 3000)] + rng.integers(-400, 400, (3000, 8, 8))
    history = x[:16].swapaxes(0, 1)[None].copy()
    a, scans = vector_codes.Assigned.unset(3000, 8), []
    for _ in range(6):
        _, n = a.advance(x, history)
        scans.append(n)
        far = np.sqrt(((x[:, :, None] - history[-1][None]) ** 2).sum(-1).astype(float))
        assert (a.code == far.argmin(-1)).all()
        part = np.arange(8)
        moved = vector_codes.net_moves(history)
        own = np.take_along_axis(far, a.code[..., None].astype(int), 2)[..., 0]
        np.put_along_axis(far, a.code[..., None].astype(int), np.inf, 2)
        assert (a.upper + moved[a.upper_at, part, a.code] >= own).all()
        assert (a.lower - vector_codes.greatest_other(moved)[a.lower_at, part, a.code] <= far.min(-1)).all()
        book = history[-1].copy()
        for p in range(8):
            for e in range(16):
                if (a.code[:, p] == e).any():
                    book[p, e] = x[a.code[:, p] == e, p].sum(0) // (a.code[:, p] == e).sum()
        history = np.concatenate([history, book[None]])
        drift = vector_codes.summed_drifts(history)
        assert (vector_codes.net_moves(history) <= drift * (1 + 1e-9) + 1e-9).all()
    assert (vector_codes.net_moves(history) < 0.99 * drift).any()
    assert scans[0] == 24000 and scans[-1] < 12000


def brute_top(rows, k=5):
    kept, x = whole(rows, 256)
    out = []
    for i, r in enumerate(kept):
        if r[0] is not None and r[0] % 50 == 0:
            best = sorted((-int(x[i] @ x[j]), kept[j][0] is None, kept[j][0] or 0) for j in range(len(kept)) if j != i)[:k]
            out += [(r[0], n + 1, None if null else v, -s) for n, (s, null, v) in enumerate(best)]
    return Counter(out)


def test_top_k(spark, vectors):
    want = brute_top(vector_rows())
    for kw in ({}, {"queries": 3, "least_rows": 20, "block": 16}, {"rows": 40, "block": 7}):
        assert Counter(map(tuple, topk.top_k(vectors, **kw).collect())) == want
    few = [r for r in vector_rows() if r[0] in (50, 100)][:3]
    assert Counter(map(tuple, topk.top_k(spark.createDataFrame(few, VECTORS)).collect())) == brute_top(few)
    assert topk.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    huge = spark.createDataFrame([(i, [3e5 * i, -4e6, 1e5]) for i in (0, 1, 2)], "vec_id long, embedding array<float>")
    assert [r["score"] for r in topk.top_k(huge).collect()] == [
        int(s) for s in (256 ** 2 * (16_000_000_000_000 + 10_000_000_000),) * 2]
    with pytest.raises(ValueError):
        topk.top_k(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>"))


def test_threshold_stops_early_and_loses_no_tie():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 4)) * [100, 5, 1, 1]
    x = np.floor(x)
    part = topk.Lists(x)
    for _ in range(20):
        q = np.floor(rng.normal(size=4) * 20)
        rows, scores, scored = part.search(q, 5, -np.inf, None)
        want = np.lexsort((np.arange(4000), -(x @ q)))[:5]
        assert rows.tolist() == want.tolist() and scores.tolist() == (x @ q)[want].tolist()
        assert scored < 2000
    same = topk.Lists(np.ones((300, 3)))
    assert same.search(np.ones(3), 5, -np.inf, 2)[0].tolist() == [0, 1, 3, 4, 5]
    assert same.search(np.zeros(3), 5, -np.inf, None)[0].tolist() == [0, 1, 2, 3, 4]
    assert same.search(np.ones(3), 5, 3.5, None)[2] == 0       # a carried k-th score ends the walk at once


# ---------------------------------------------------------------- conversations
def turn_rows():
    rng = random.Random(4)
    texts = ["Yes.", "no", "Why?", "", " ", "go on", "Fine!\n", "a. b", None, "é."]
    out = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            out.append((c, rng.choice([t, t, t, t + 3, None]), role, rng.choice(texts) or None))
    out += [(None, t, "user", f"hm {t}.") for t in range(8)] + [(70, None, None, None)] * 3 + [out[0], out[0], out[5]]
    out += [(80, t, "user" if t % 2 else "assistant", "same.") for t in range(40)]
    out += [(90, t, rng.choice(["user", "assistant"]), f"{t} {rng.random()}" + rng.choice([".", ""])) for t in range(120)]
    out += [(91, t, "user", "") for t in range(50)]
    return [(*r, "p", 1, 2, "K", 3) for r in out]


def signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def brute_damage(rows):
    out = []
    for c, t, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            out += [(c, t, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def brute_repair(rows, ids):
    by = {c: [] for c in ids}
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role, signed(text), t, text))
    result = {}
    for c, turns in by.items():
        turns = sorted(turns)
        seen, kinds, counts = set(), [], Counter()
        for *_, role, _h, _t, text in turns:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = ("blank" if not words else "duplicate" if (role, text) in seen
                    else "truncated" if words[-1] not in ".!?" else "")
            seen.add((role, text))
            counts[kind] += 1
            kinds.append(kind)
        # least (cost, audit) of what follows, from the end; states are the roles so far
        ends = {"": "u", "s": "u", "u": "a", "a": "u"}
        best = {q: (0, "", ()) for q in ("", "a")}

        def insertions(best):
            for _ in range(4):
                for q, r in ends.items():
                    if r in best:
                        cost, audit, out = best[r]
                        new = (cost + 3, "I" + audit, (({"u": "user", "a": "assistant"}[r], ""), *out))
                        best[q] = min(best.get(q, new), new)
            return best

        best = insertions(best)
        for kind, (*_, role, _h, _t, text) in zip(kinds[::-1], turns[::-1]):
            before = {}
            extra = 3 if kind == "truncated" else 0
            for q, r in ends.items():
                options = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
                if kind not in ("blank", "duplicate"):
                    b = best[r]
                    options.append((b[0] + 3 + extra, "R" + b[1], (({"u": "user", "a": "assistant"}[r], text), *b[2])))
                    i = role[:1]
                    if i and (i == r or (q == "" and i == "s")):
                        b = best[i]
                        options.append((b[0] + extra, "K" + b[1], ((role, text), *b[2])))
                before[q] = min(options)
            best = insertions(before)
        cost, audit, out = best[""]
        numbers = [t[4] for t in turns if t[4] is not None]
        initials = [t[2][:1] for t in turns]
        result[c] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, counts["blank"], counts["duplicate"],
                     counts["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost,
                     audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    return result


def test_repair(spark):
    rows = turn_rows()
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    want = brute_repair(brute_damage(rows), {r[0] for r in rows})
    for kw in ({}, {"chunk_bits": 2}, {"chunk_bits": 0, "fix_passes": 2}, {"chunk_bits": 3, "fix_passes": 0}):
        got = conversations.summaries(conversations.repair(conversations.damaged(df), df, **kw)).collect()
        assert {r["conv_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want), kw
    edits = conversations.repair(conversations.damaged(df), df)
    letters = "".join(r["role"][0] for r in edits.where("conv_id = 90 and edit <> 'D'").collect())
    assert re.fullmatch("(s?(ua)+)?", letters)


def test_repair_of_no_rows(spark):
    assert conversations.repaired_conversations(spark.createDataFrame([], TURNS)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = conversations.repaired_conversations(spark.createDataFrame([(gone, 0, "user", "x.")], "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in got.collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_fix_up_stops_where_vectors_converge():
    rng = random.Random(2)
    kinds = "".join(rng.choices("uaUAsB", k=500))
    old = list(conversations.GUESS)
    reached = conversations.run_back(kinds, old)
    for new in ([0, 6, 3, 0], [5, 1, 0, 4], [9, 9, 9, 9]):
        out, passed = conversations.rerun(kinds, old, reached, new)
        assert out == conversations.run_back(kinds, new)
        assert passed < 100
    assert conversations.rerun("B" * 50, old, conversations.run_back("B" * 50, old), [0, 2, 3, 0])[1] == 50
