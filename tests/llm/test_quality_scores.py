"""Score and verdict of the quality rules against plain counting."""
import math
import random
import re
from collections import Counter

import pytest
import xxhash

from txrisk.llm import quality

WORD = r"[^\x20\x09-\x0D]+"


def _grams(text):
    low = [w.lower().encode() for w in re.findall(WORD, text or "")]
    one = [xxhash.xxh64_intdigest(w, 42) for w in low]
    return [h % quality.BUCKETS for h in one] + [
        xxhash.xxh64_intdigest(b, h) % quality.BUCKETS for h, b in zip(one, low[1:])]


def _score(text, raw, target):
    n, m, total = sum(raw.values()), sum(target.values()), 0.0
    for g in (grams := _grams(text)):
        share = raw[g] / n
        total += math.log((target[g] + quality.PRIOR * share) / (m + quality.PRIOR) / share)
    return total / len(grams) if grams else 0.0


@pytest.mark.parametrize("trusted_ids", [set(), {1}, set(range(0, 400, 2))])
def test_score_and_kept_equal_plain_counting(spark, trusted_ids):
    r = random.Random(5)
    words = {k: [f"{k}{i}" for i in range(200)] for k in ("good", "Junk")}
    rows = [(i, " ".join(r.choices(words["good" if i % 2 == 0 else "Junk"], k=r.choice([5, 60, 400, 3000])))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "one"), (1, "a repeated id"), (None, "no id " * 40), rows[2], rows[2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in sorted(trusted_ids)] + [(None,)], "doc_id long")
    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(_grams(t))
        if d in trusted_ids:
            target.update(_grams(t))
    want = sorted((-1 if d is None else d, round(_score(t, raw, target), 8)) for d, t in rows)
    got = quality.quality_rules(docs, trusted).collect()
    assert [a for a, _ in want] == sorted(-1 if x.doc_id is None else x.doc_id for x in got)
    mine = sorted((-1 if x.doc_id is None else x.doc_id, round(x.score, 8)) for x in got)
    assert all(a == b and math.isclose(s, t, abs_tol=2e-8) for (a, s), (b, t) in zip(mine, want))
    assert all(x.kept == (not x.base_failed and round(x.score, 9) >= quality.THRESHOLD) for x in got)
    if len(trusted_ids) > 1:  # the verdict rejects long junk and keeps long good texts
        assert any(not x.kept and not x.base_failed for x in got)
        assert all(x.kept for x in got if x.doc_id in trusted_ids and not x.base_failed)
