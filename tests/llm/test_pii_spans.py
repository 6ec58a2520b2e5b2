"""Added spans against a plain pairwise test, texts with very many spans, edge rows."""
import random
import time

import pytest
from pyspark.sql import functions as F

from txrisk.llm import pii


def _plain(text):
    """Every proposal against every held span, one by one."""
    found = [(k, s, e) for k, s, e in pii.base_spans(text)]
    for kind, s, e, confirmed in pii._proposals(text):
        p = pii.score(text, kind, s, e, confirmed)
        if p >= pii.KEEP and (kind == "iban" or p > pii.PRIOR[kind] + pii.VALID * confirmed) and \
                all(e <= a or b <= s for _, a, b in found):
            found.append((kind, s, e))
    return sorted(found, key=lambda x: (pii.KINDS.index(x[0]), x[1]))


PIECES = ["4111 1111 1111 1111", "378282246310005", "card", "visa ", "555-123-4567", "(415) 555-2671", "call", "phone: ",
          "ssn 123-45-6789", "123-45-6789", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "iban ", "10.0.0.1",
          "a.b@c.de", "+1 (415) 555-2671", "+49 30 901820", " ", ", ", "-", ".", "1", "x", "\n", "0", "é"]


@pytest.mark.parametrize("seed", range(6))
def test_added_spans_equal_the_pairwise_test(seed):
    r = random.Random(seed)
    added = 0
    for _ in range(150):
        text = "".join(r.choice(PIECES) + r.choice(["", " "]) for _ in range(r.randrange(60)))
        got = [(k, s, e) for k, s, e, _ in pii.spans(text)]
        assert got == _plain(text), text
        added += len(got) - len(pii.base_spans(text))
    assert added > 50


def test_held_ground():
    held = pii._Held([(5, 9), (0, 3), (7, 12), (12, 14)])
    assert held.take(3, 5) and not held.take(2, 4) and not held.take(13, 20) and held.take(14, 20)
    assert not held.take(0, 100) and held.take(20, 21)


def test_many_spans_in_one_text():
    """Work follows the number of spans: four times the spans, far less than sixteen times the time."""
    def seconds(n):
        text = "phone 555-123-4567 ssn 123-45-6789 " * n
        start = time.perf_counter()
        assert len(pii.spans(text)) == 2 * n
        return time.perf_counter() - start
    seconds(100)
    assert seconds(20000) < 9 * seconds(5000)


def test_rows_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, "phone 555-123-4567", "x"), (1, "phone 555-123-4567", None), (2, None, "y"), (3, "", "z"), (None, "a.b@c.de", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((r.doc_id or 0, r.n_email, r.n_phone, r.spans, len(r.scores)) for r in pii.find_pii(docs).collect())
    assert got == [(0, 1, 0, "email:0:8", 1), (1, 0, 0, "phone:6:18", 1), (1, 0, 0, "phone:6:18", 1), (2, 0, 0, "", 0), (3, 0, 0, "", 0)]
    assert pii.find_pii(docs.where(F.lit(False))).count() == 0
