"""Operators against brute force on a small fixture: nulls in every column, empty and
long texts, ties, repeated rows, columns with clashing names; and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from txrisk.llm import (exact_dedup, lm_score, mixing, packing, pii, quality, rollups, simhash,
                        suffix_dedup, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _n long, _rank string, size string"
WORD = r"[^\x20\x09-\x0D]+"


def rows():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abdeilnorst") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    shared = text(40)
    texts = [text(rng.randint(1, 120)) for _ in range(30)]
    texts += [texts[0], texts[0].replace(" ", "  "), texts[3] + "\n", None, "", " \t\n", "é ß 漢字 😀 it's, A-B!", "x" * 400,
              shared + " " + text(30), text(20) + " " + shared, (text(9) + "\n") * 6, text(4000)]
    near = text(150).split()
    for k in range(6):
        texts.append(" ".join([*near[:k], "zz", *near[k + 1:]]))
    out = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 7 else None, 1, i, "r", "x") for i, t in enumerate(texts)]
    return [*out, out[1], out[1], (None, texts[5], None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0)


def test_exact_groups(docs, empty):
    groups = {}
    for d, t, *_ in rows():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d))
    for heavy_min in (2, 64):
        got = exact_dedup.exact_groups(docs, heavy_min).collect()
        assert len(got) == len(rows())
        for norm, members in groups.items():
            mine = [r for r in got if r["text_sha256"] == hashlib.sha256(norm.encode()).hexdigest()]
            assert len(mine) == len(members) and {r["keep_id"] for r in mine} == {min(members)[2]}
            assert sum(r["kept"] for r in mine) == 1 and {r["group_size"] for r in mine} == {len(members)}
        kept = exact_dedup.drop_exact_copies(docs, heavy_min)
        assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_groups(empty).count() == 0


def fingerprint(t):
    w = (t or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    ones = Counter(b for s in sh for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(sh)) if sh else 0


def test_near_groups(docs, empty):
    fps = [(d, fingerprint(t)) for d, t, *_ in rows()]
    comp = {f: f for _, f in fps}
    for a in comp:
        for b in comp:
            if (a ^ b).bit_count() <= 4:
                old, new = comp[a], comp[b]
                comp = {k: new if v == old else v for k, v in comp.items()}
    least = {}
    for d, f in fps:
        if d is not None:
            least[comp[f]] = min(least.get(comp[f], d), d)
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.near_groups(docs).collect())
    assert got == sorted((str(d), f"{f:016x}", least.get(comp[f])) for d, f in fps)
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns and one.count() == len(set(comp.values()))
    assert simhash.near_groups(empty).count() == 0


def test_one_of_each_keeps_a_row_of_every_component(spark):
    """Unrelated texts without an id, and components that share an id."""
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choices("abdeilnorst", k=6)) for _ in range(60))
    alone = [text() for _ in range(5)]
    a, b, c = text(), text(), text()
    data = [(None, t) for t in alone] + [(1, a), (2, b), (1, b), (2, b), (7, c), (7, alone[0]), (None, c)]
    for parts in (1, 4):
        got = simhash.one_of_each(spark.createDataFrame(data, "doc_id long, text string").repartition(parts)).collect()
        assert Counter(map(tuple, got)) == Counter([*[(None, t) for t in alone[1:]], (7, alone[0]), (1, a), (1, b), (7, c)])


def test_link_forest_keeps_components_in_blocks(spark):
    rng = random.Random(1)
    centre = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centre for _ in range(60)}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for block in (2048, 7):
        n = simhash.components(simhash.link_forest(df, block=block)).select("root").distinct().count()
        left = set(fps)
        count = 0
        while left:
            todo, count = [left.pop()], count + 1
            while todo:
                x = todo.pop()
                near = {y for y in left if (x ^ y).bit_count() <= 4}
                left -= near
                todo += near
        alone = len(fps) - simhash.components(simhash.link_forest(df, block=block)).count()
        assert n + alone == count


def test_suffix_dedup(docs, empty):
    data = [(math.inf if d is None else d, (t or "").encode()) for d, t, *_ in rows()]
    first = {}
    for d, b in data:
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], d), d)
    want = []
    for d, b in data:
        m = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < d:
                m[p:p + 50] = True
        spans = int((np.diff(np.concatenate(([0], m.astype(int)))) == 1).sum())
        want.append((str(None if d == math.inf else d), len(b), int(m.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~m])).hexdigest()))
    for sizes in ((8 << 20, 48 << 20), (3000, 9000)):
        got = [(str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
               for r in suffix_dedup.repeated_passages(docs, *sizes).collect()]
        assert sorted(got) == sorted(want)
    assert suffix_dedup.repeated_passages(empty).count() == 0


def test_language_model(docs, empty):
    train = Counter()
    for d, t, *_ in rows():
        if zlib.crc32(str("" if d is None else d).encode()) % 5 != 1:
            train.update([*(t or "").encode().lower().split(), None])
    n, v = sum(train.values()), len(train)
    base = lambda t: sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*(t or "").encode().lower().split(), None])
    got = lm_score.ctw_scores(docs, chunk_bytes=4000).collect()
    assert sorted(round(r["base_score"], 6) for r in got) == pytest.approx(sorted(base(t) for _, t, *_ in rows()))
    assert {r["train_tokens"] for r in got} == {n} and all(r["score"] < 0 for r in got)
    whole = {(r["doc_id"], r["n_bytes"]): r["score"] for r in lm_score.ctw_scores(docs).collect()}
    assert all(whole[r["doc_id"], r["n_bytes"]] == pytest.approx(r["score"], rel=1e-5) for r in got)
    assert lm_score.ctw_scores(empty).count() == 0


def test_context_tree_by_hand():
    """Depth-2 trees of one last byte against the recursion written out."""
    grams = np.array([(97 << 16) | (98 << 8) | b for b in (120, 121)] + [(97 << 16) | (99 << 8) | 120], np.int64)
    counts = np.array([3, 1, 2])
    tree = lm_score.Tree(grams, counts, 2)
    kt = lambda a, b: math.exp(lm_score.log_kt(np.array([a]), np.array([b]))[0])
    assert kt(1, 1) == pytest.approx(1 / 8) and kt(2, 0) == pytest.approx(3 / 8)
    top = tree.top()
    assert top[0, 1] == 6 and top[1, 1] == 0                      # first bit of x and y is 0
    one = lm_score._decisions([{"j": j, "n0": top[0, j], "n1": top[1, j], "lp": top[2, j]} for j in range(256)])
    j = 128 | (120 >> 1)                                          # last bit: x 0, y 1
    both = 0.5 * kt(5, 1) + 0.5 * kt(3, 1) * kt(2, 0)
    assert one[3, j] == pytest.approx(math.log(both)) and one[2, j] == pytest.approx(0.5 * kt(5, 1) / both)
    every = np.arange(256) + ((97 << 16) | (98 << 8))
    p = 10 ** tree.log10_prob(every, one[:3], one[:3])
    assert p.sum() == pytest.approx(1)


def test_mixing(docs, empty):
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(rows()) and all(r["taken"] <= 3 * r["size"] for r in got)
    size = {}
    for _, t, _, s, *_ in rows():
        size[s] = size.get(s, 0) + len(re.findall(WORD, t or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight, total, full = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, sum(size.values()), set()
    while True:
        rate = (total - sum(3 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and rate * weight[s] > 3 * size[s]}
        if not more:
            break
        full |= more
    want = {3.0 * size[s] if s in full else rate * weight[s] for s in order}
    targets = {r["target"] for r in got}
    assert sorted(targets) == pytest.approx(sorted(want))
    source, taken = {d: s for d, _, _, s, *_ in rows()}, Counter()
    for r in got:
        taken[source[r["doc_id"]], r["target"]] += r["taken"]
    assert all(n == pytest.approx(t, abs=60) for (_, t), n in taken.items())
    again = mixing.mix_documents(docs.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    repeated = mixing.repeat_documents(docs)
    words = sum(len(re.findall(WORD, r["text"] or "")) for r in repeated.collect())
    assert repeated.columns == docs.columns and words == sum(r["taken"] for r in got)
    assert mixing.mix_documents(empty).count() == 0


def test_packing(docs, empty):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public.path(packing.TOKENIZER))
    got = packing.pack(docs).collect()
    pieces, seqs = {}, {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        pieces.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    want = Counter()
    for d, t, *_ in rows():
        want[d, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    for (d, ids), n in want.items():
        mine = sorted(pieces[d], key=lambda r: r["start"])
        assert n > 1 or b"".join(r["ids"] for r in mine) == ids
        assert sum(r["length"] for r in mine) * 4 == n * len(ids)
    waste = 0
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        waste += 0 if at & (at - 1) == 0 else 2048 - at
    assert waste < 0.02 * sum(r["length"] for r in got)
    assert packing.pack(empty).count() == 0


def test_column_generation_reaches_the_bound():
    sizes, demand = np.array([3, 5, 7, 11]), np.array([40.0, 30, 20, 10])
    used = packing.solve_patterns(sizes, demand, 20)
    assert sum(x for _, x in used) <= (sizes @ demand) / 20 * 1.01
    worth, pattern = packing.best_pattern(np.array([3.0, 5, 7.5, 11]), sizes, 20)
    assert sum(sizes[k] * c for k, c in pattern.items()) <= 20 and worth == pytest.approx(20 + 0.5 * pattern.get(2, 0))


def test_packing_leftover_does_not_grow_with_the_corpus(monkeypatch):
    """An over-covered class: surplus items go, not whole sequences."""
    first_fit, seen = packing.first_fit, []
    monkeypatch.setattr(packing, "first_fit", lambda sizes, left, cap: seen.append(int(left.sum())) or first_fit(sizes, left, cap))
    rng = random.Random(4)
    mixed = {c: rng.randint(1, 400) for c in rng.sample(range(1, 513), 60)}
    for hist in ({12: 10, 100: 1000, 300: 1000}, {12: 1000, 100: 100_000, 300: 100_000}, mixed):
        rows, recut_from, n_seq = packing.layout(hist, 512)
        patterns = packing.solve_patterns(np.array(sorted(hist)), np.array([float(hist[c]) for c in sorted(hist)]), 512)
        assert seen.pop() <= sum(sum(p.values()) for p, _ in patterns)
        used, filled = Counter(), Counter()
        for c, start, stop, seq, each, _ in sorted(rows, key=lambda r: (r[0], r[1])):
            assert start == used[c] and (stop - start) % each == 0
            used[c] = stop
            for k in range((stop - start) // each if n_seq < 10_000 else 1):
                filled[seq + k] += c * each
        assert recut_from == {c: used[c] for c in hist} and all(used[c] <= n for c, n in hist.items())
        assert max(filled.values(), default=0) <= 512 and max(filled, default=-1) < n_seq


def test_packing_recuts_what_patterns_cannot_fill(spark):
    """Remainders just over half a sequence, and documents far shorter than a class."""
    pytest.importorskip("public_tokenizers")
    assert packing.layout({257: 1000}, 512)[::2] == ([], 0)
    for sizes in ([1028] * 90, [1200] * 70 + [40] * 5, [1] * 3000):
        data = [(i, "7 " * (n - 1)) for i, n in enumerate(sizes)]
        got = packing.pack(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).collect()
        length, filled = Counter(), Counter()
        for r in got:
            length[r["doc_id"]] += r["length"]
            filled[r["sequence_id"]] += r["length"]
        assert length == dict(enumerate(sizes))
        padding = sum((1 << (n - 1).bit_length()) - n for n in filled.values())
        assert padding < 0.02 * sum(sizes) and max(filled.values()) <= 2048


def test_first_fit_by_counts_equals_one_by_one():
    rng = random.Random(9)
    for _ in range(60):
        sizes = np.array(sorted(rng.sample(range(1, 60), rng.randint(1, 9))), np.int64)
        left = np.array([rng.choice([0, 1, 2, 7, 40]) for _ in sizes])
        bins, free = [], []
        for k in range(len(sizes) - 1, -1, -1):
            for _ in range(left[k]):
                at = next((i for i, f in enumerate(free) if f >= sizes[k]), len(free))
                if at == len(free):
                    bins.append(Counter())
                    free.append(60)
                bins[at][k] += 1
                free[at] -= sizes[k]
        got = [items for items, n in packing.first_fit(sizes, left, 60) for _ in range(n)]
        assert got == [dict(b) for b in bins]


def test_recut_lays_remainders_end_to_end(spark, monkeypatch):
    monkeypatch.setattr(packing, "RECUT_BLOCK", 7)
    rng = random.Random(2)
    rem = sorted((rng.choice([5, 6, 120, 300]) for _ in range(150)), reverse=True)
    rank, data = Counter(), []
    for i, r in enumerate(rem):
        c = -(-r // 4)
        data.append((i, 2048 + r, r, c, 3 + rank[c]))
        rank[c] += 1
    pool = spark.createDataFrame(data, "_row long, _n long, _rem long, _class int, _rank long").repartition(5)
    recut, n = packing._recut(pool, 10, 512)
    got = sorted((r["seq"], r["_at"], r["_row"], r["start"], r["length"]) for r in recut.collect())
    place = 0
    for seq, at, row, start, length in got:
        assert at == place and 10 <= seq < 10 + n
        place += length
    assert place == sum(rem)
    fills = Counter()
    for seq, _, _, _, length in got:
        fills[seq] += length
    assert len(fills) == n and all(f == 512 or f & (f - 1) == 0 for f in fills.values())
    owner = {}
    for _, _, row, start, length in got:
        assert start == owner.get(row, 2048)
        owner[row] = start + length
    assert owner == {i: 2048 + r for i, r in enumerate(rem)}
    plan = recut._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


PII = [("mail a.b+c@x-y.example.com, x@y z", "email:5:26"), ("1.2.3.4.5.6.7.8 300.1.1.1", "ip:0:7,ip:8:15"),
       ("card 4111 1111 1111 1111 ok", "card:5:24"), ("4111 1111 1111 1112", ""), ("+1 (377) 555-0271 x", "phone:0:17"),
       ("my iban DE89 3704 0044 0532 0130 00 ok", "iban:8:35"), ("DE89 3704 0044 0532 0130 01", ""),
       ("call 555-123-4567 now", "phone:5:17"), ("555-123-4567 apples", ""), ("ssn 123-45-6789", "ssn:4:15"),
       ("123-45-6789", ""), ("", ""), ("a@b.c@d.e", "email:0:5"), ("a@b.c_d@e.f", "email:0:5,email:5:11")]


@pytest.mark.parametrize("text,want", PII)
def test_pii_spans(text, want):
    assert ",".join(f"{k}:{s}:{e}" for k, s, e, _ in pii.spans(text)) == want


DE, NO = "DE89 3704 0044 0532 0130 00", "NO9386011117947"


@pytest.mark.parametrize("text,want", [
    (f"{DE} BIC COBADEFF", "iban:0:27"), (f"{DE} EUR 100", "iban:0:27"), (f"{DE} 2024-01-05", "iban:0:27"),
    (f"{DE} 7", "iban:0:27"), (f"IBAN XX12 {DE} {NO} OK", "iban:10:37,iban:38:53"), (f"{DE}7", ""), (f"{DE}a", ""),
    (f"{DE[:-1]} 0", "iban:0:28"),
    (f"{NO} {DE}", "iban:0:15,iban:16:43"), ("GB82 WEST 1234 5698 7654 32 AND MORE", "iban:0:27"), ("DE89 3704 0044", "")])
def test_pii_iban_before_other_tokens(text, want):
    assert ",".join(f"{k}:{s}:{e}" for k, s, e, _ in pii.spans(text)) == want


def test_pii_iban_of_a_country_not_listed():
    body = "ABCD1234567890123"
    code = next(c for c in (f"ZZ{k:02}{body}" for k in range(2, 99)) if pii.mod97(c))
    for after in ("", " EUR 100", " 20240105 X9"):
        found = pii.spans(f"iban {code}{after}")
        assert [(k, s) for k, s, *_ in found] == [("iban", 5)]
        assert found[0][2] == 5 + len(code) or pii.mod97(f"iban {code}{after}"[5:found[0][2]].replace(" ", ""))


def test_pii_base_equals_the_plain_patterns():
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice("ab1.23@+- ()_%47é\n") for _ in range(rng.randint(0, 60)))
        want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) < 256 for p in m[0].split("."))]
        want += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and pii.luhn(d)]
        want += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.findall("[0-9]", m[0])) <= 15]
        assert pii.base_spans(t) == want, t


def test_pii_rows(docs, empty):
    assert pii.find_pii(docs).count() == len(rows()) and pii.find_pii(empty).count() == 0


def test_quality_rules(spark, docs, empty):
    trusted = docs.where("doc_id between 0 and 20").select("doc_id")
    got = Counter(tuple(r)[:7] for r in quality.quality_rules(docs, trusted).collect())
    want = Counter()
    for d, t, *_ in rows():
        t = t or ""
        w = re.findall(WORD, t)
        tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        cover = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        want[d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), failed] += 1
    assert got == want
    assert quality.quality_rules(empty, trusted).count() == 0


def test_quality_keeps_good_documents_with_any_number_of_trusted_ones(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abdeilnorst", k=7))
    good, junk = [word() for _ in range(300)], [word() for _ in range(300)]
    data = [(i, " ".join(rng.choices(junk if i >= 2050 else good, k=100))) for i in range(2100)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    for n in (0, 1, 20, 300, 2000):  # 0 to 400,000 trusted n-grams; 2,000 to 2,049 are good and never trusted
        got = quality.quality_rules(docs, docs.where(F.col("doc_id") < n).select("doc_id")).collect()
        assert all(r["kept"] for r in got if r["doc_id"] < 2050)
        assert n or {r["score"] for r in got} == {0.0}
    assert not any(r["kept"] for r in got if r["doc_id"] >= 2050)


def test_toxicity_learns_stems_and_reads_disguises(spark, empty):
    rng = random.Random(2)
    plain = ["the", "house", "green", "river", "walks", "along", "stone", "idle", "moss", "other"]
    rows_, labels_ = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = rng.choices(plain, k=20) + ([rng.choice(["moron", "morons", "moronic"])] * 2 if bad else [])
        rng.shuffle(words)
        rows_.append((i, " ".join(words)))
        labels_.append((i, int(bad)))
    hidden = ["the m0r0n walks", "the m o r o n walks", "mooooron river", "green m.o.r.o.n house"]
    rows_ += [(10_000 + i, t) for i, t in enumerate(hidden)] + [(20_000, "the green river"), (20_001, None), (None, "")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    labels = spark.createDataFrame([*labels_, (None, 1), (5, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(got[i]["predicted"] == int(i % 5 == 0) for i in range(600))
    assert [got[10_000 + i]["predicted"] for i in range(4)] == [1] * 4
    assert [got[i]["predicted"] for i in (20_000, 20_001, None)] == [0] * 3
    assert toxicity.toxicity(docs, labels.limit(0)).agg(F.max("predicted")).head()[0] == 0
    assert toxicity.toxicity(empty.select("doc_id", "text"), labels).count() == 0


def test_toxicity_reads_inner_separators_and_doubled_letters():
    plain = ["the", "house", "green", "river", "walks", "along", "stone", "idle", "moss", "other", "moron", "morons", "idiot"]
    counts = Counter()
    for w in plain:
        c = toxicity._codes(w)
        for a, b, d in zip(c, c[1:], c[2:]):
            counts[(a * toxicity.ALPHABET + b) * toxicity.ALPHABET + d] += 1000
    model = toxicity.log_model(list(counts.items()))
    read = lambda t: tuple(toxicity.reading(t, model).split())
    for tok, word in [("mo-ron", "moron"), ("mo.ro.ns", "morons"), ("i-diot", "idiot"), ("mooron", "moron"), ("idiiot", "idiot"),
                      ("mor--on", "moron"), ("mo_ron", "moron"), ("moorroon", "moron"), ("m.oro.n", "moron"), ("(id'iot),", "idiot")]:
        assert read(tok) == (word,), tok
    for tok in ("green-river", "stone.the", "walks/along", "moss--idle"):
        assert read(tok) == tuple(re.findall("[a-z]+", tok))
    assert [read(w) for w in plain] == [(w,) for w in plain]


def test_rollup_is_idempotent(spark, docs, tmp_path):
    r = rollups.Rollup(spark, f"file://{tmp_path}")
    assert r.commit("a", rollups.signed(docs, "words-1", 1)) and not r.commit("a", rollups.signed(docs, "words-1", 1))
    total = r.totals(["a"]).agg(F.sum("n_docs"), F.sum("n_tokens")).head()
    assert tuple(total) == (len(rows()), sum(len(re.findall(WORD, t or "")) for _, t, *_ in rows()))
    r.commit("b", rollups.signed(docs, "words-1", -1))
    assert r.totals(["a", "b", "never"]).count() == 0
