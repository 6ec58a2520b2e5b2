"""Personal data: regular expressions propose spans, checksums confirm them, context
words adjust the score.

Four base kinds (email, ip, card, phone) keep every confirmed match whatever its
score. Further proposals are kept where prior, validator and context together reach
``KEEP``:

- iban: country code, two check digits, letters or digits up to the country's length
  (any length from 15 to 34 for a country not listed); mod-97 must be 1;
- card: 13 to 15 digits passing Luhn, with a payment word nearby;
- phone: 10 to 11 digits in national grouping, with a telephone word nearby;
- ssn: 3-2-4 digits in an assigned range, with an identity word nearby.

Every pattern starts at a maximal run, so the work is linear in the text however long
its runs of digits or letters are. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from txrisk.llm.common import text_of

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
KEEP = 0.8
NEAR = 40            # code points of context on either side
PRIOR = {"email": 0.9, "ip": 0.8, "card": 0.6, "phone": 0.7, "iban": 0.5, "ssn": 0.4}
VALID = 0.35         # a checksum holds
CONTEXT = 0.45       # a word of the kind stands nearby
#: Words that speak for a kind.
WORDS = {
    "email": r"e-?mail|contact|write to|reach",
    "ip": r"ip|address|server|host|login",
    "card": r"card|visa|mastercard|amex|payment|credit|debit|cc",
    "phone": r"phone|tel|call|mobile|fax|cell|text",
    "iban": r"iban|account|bank|transfer|konto",
    "ssn": r"ssn|social security|tax id|national id",
}
_CONTEXT = {k: re.compile(rf"(?<![a-z])(?:{w})(?![a-z])", re.I) for k, w in WORDS.items()}

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_RUN = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL.pattern)
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_NEXT = re.compile(r" ?([A-Z0-9])")
_ALNUM = re.compile(r"[A-Za-z0-9]")
#: Length of an IBAN by country (ISO 13616 registry).
IBAN_LENGTH = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}.items() for c in cs.split()}
IBAN_SHORTEST, IBAN_LONGEST = 15, 34
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_NATIONAL = re.compile(r"(?<![0-9+.-])(?:1[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """ISO 13616 check of an IBAN without spaces."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    if "@" not in text:
        return
    while m := _EMAIL.match(text, at) or _EMAIL_RUN.search(text, at):
        yield m.span()
        at = m.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts, at = chain[0].split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans that pass mod-97 at their country's length, or for a country not listed at
    the longest length that does. A span ends where a run of letters or digits ends; the
    search goes on after a confirmed span, or else after the start that failed."""
    at = 0
    while m := _IBAN.search(text, at):
        at, code, ends = m.end(), m[0], []
        fixed = IBAN_LENGTH.get(code[:2])
        end = m.end()
        while len(code) < (fixed or IBAN_LONGEST) and (c := _IBAN_NEXT.match(text, end)):
            code, end = code + c[1], c.end()
            if len(code) >= (fixed or IBAN_SHORTEST) and not _ALNUM.match(text, end):
                ends.append((len(code), end))
        for n, end in reversed(ends):
            if mod97(code[:n]):
                yield m.start(), end
                at = end
                break


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the four base kinds, by kind, then start."""
    out = [("email", *s) for s in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", *s) for s in _ips(text)]
    for m in _CARD.finditer(text):
        d = _digits(m[0]) if m.end() - m.start() < 64 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def _proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a checksum confirms it) beyond the base kinds."""
    for span in _ibans(text):
        yield "iban", *span, True
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 64 and 13 <= len(d := _digits(m[0])) <= 15 and luhn(d):
            yield "card", *m.span(), True
    for m in _NATIONAL.finditer(text):
        yield "phone", *m.span(), False
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", *m.span(), False


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    near = text[max(0, start - NEAR):start] + " | " + text[end:end + NEAR]
    return min(1.0, PRIOR[kind] + VALID * confirmed + CONTEXT * bool(_CONTEXT[kind].search(near)))


class _Held:
    """The ground that spans cover, as disjoint intervals in order: an overlap is found by
    bisection, so a text with many spans costs no more than its spans times their logarithm."""

    def __init__(self, taken: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for s, e in sorted(taken):  # base spans of different kinds may overlap
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def take(self, s: int, e: int) -> bool:
        """Adds the interval unless it overlaps one that is held."""
        at = bisect_left(self.starts, e)  # the intervals before it start before the end
        if at and self.ends[at - 1] > s:
            return False
        self.starts.insert(at, s)
        self.ends.insert(at, e)
        return True


def spans(text: str, base: list[tuple[str, int, int]] | None = None) -> list[tuple[str, int, int, float]]:
    """All spans with their scores, by kind as in ``KINDS``, then start. An added span
    never overlaps a base one or an added one of higher rank. ``base``: the text's
    ``base_spans`` where they are at hand."""
    base = base_spans(text) if base is None else base
    found = [(k, s, e, score(text, k, s, e, k in ("card", "ip"))) for k, s, e in base]
    if not _DIGIT.search(text):
        return found
    held = _Held([(s, e) for _, s, e in base])
    for kind, s, e, confirmed in _proposals(text):
        # A checksum or a context word is needed: the priors alone stay below KEEP.
        p = score(text, kind, s, e, confirmed)
        need = p >= KEEP and (kind == "iban" or p > PRIOR[kind] + VALID * confirmed)
        if need and held.take(s, e):
            found.append((kind, s, e, p))
    return sorted(found, key=lambda x: (KINDS.index(x[0]), x[1]))


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base_spans and spans as strings of
    ``kind:start:end``, scores (one per span) and the base counts.

    Null and empty texts have no spans; repeated rows give repeated results; other
    columns are not read; an empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = {k: [] for k in KINDS[:4]}
            base, every, scores = [], [], []
            for text in b.column(1).to_pylist():
                found = base_spans(text)
                base.append(",".join(f"{k}:{s}:{e}" for k, s, e in found))
                for k in counts:
                    counts[k].append(sum(f[0] == k for f in found))
                scored = spans(text, found)
                every.append(",".join(f"{k}:{s}:{e}" for k, s, e, _ in scored))
                scores.append([p for *_, p in scored])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts.values()],
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                 pa.array(every, pa.string()), pa.array(scores, pa.list_(pa.float64()))],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"])

    schema = (f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string, scores array<double>")
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
