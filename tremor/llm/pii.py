"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of
their pattern that pass a check: parts of an ip at most 255, 13 to 19 card
digits passing Luhn, 9 to 15 phone digits.  They are always kept.

Further kinds are kept where their score reaches ``KEEP``: an IBAN (mod-97
confirms it), a social security number (its number ranges confirm it) and a date
of birth (a valid date).  A score starts at the kind's own value and changes
with words close to the span: words that announce such data raise it, words of
test data lower it.  Every span has a score.

Offsets are code points, end exclusive.  Null and empty texts have no spans.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import as_text, id_text, map_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "birth")
KEEP = 0.6
AROUND = 48

# One scan takes each run of local-part characters whole and then tries the domain, so a long run without
# "@" is read once: the matches are those of the plain pattern.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(?P<rest>@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]++(?P<rest>(?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_BIRTH = re.compile(r"(?<![0-9./-])(?:([0-9]{4})-([0-9]{2})-([0-9]{2})|([0-9]{2})[./]([0-9]{2})[./]([0-9]{4}))(?![0-9./-])")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+")

_START = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.5, "birth": 0.3}
_HINTS = {
    "email": {"email", "mail", "contact", "write"},
    "ip": {"ip", "address", "host", "server", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "cell", "telephone"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
    "birth": {"born", "birth", "birthday", "dob", "geboren", "naissance", "nacimiento"},
}
_DOUBTS = {"example", "sample", "test", "dummy", "fake", "version", "invoice", "isbn"}


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    rest = 0
    for c in iban[4:] + iban[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def _ip_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _ssn_ok(m: re.Match) -> bool:
    area, group, serial = m.groups()
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _birth_ok(m: re.Match) -> bool:
    """A date of the calendar from 1900 to 2099; day and month in either order, where there is a choice."""
    y, mo, d = map(int, m.group(1, 2, 3) if m[1] else (m[6], m[5], m[4]))
    if not m[1] and mo > 12 >= d:
        mo, d = d, mo
    return 1900 <= y <= 2099 and 1 <= mo <= 12 and 1 <= d <= calendar.monthrange(y, mo)[1]


#: Characters of an IBAN by country.
_IBAN_LENGTH = dict(re.findall(r"([A-Z]{2})(\d\d)", """
AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18
GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15
PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"""))


def _iban_ok(text: str) -> bool:
    code = text.replace(" ", "")
    return len(code) == int(_IBAN_LENGTH.get(code[:2], len(code))) and 15 <= len(code) <= 34 and mod97(code)


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind, by kind and start."""
    if "@" in text:
        yield from (("email", *m.span()) for m in _EMAIL.finditer(text) if m["rest"])
    if not _DIGIT.search(text):
        return
    if text.count(".") > 2:
        yield from (("ip", *m.span()) for m in _IP.finditer(text) if m["rest"] and _ip_ok(m[0]))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(n := _digits(m[0])) <= 19 and luhn(n):
            yield ("card", *m.span())
    if "+" in text:
        yield from (("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15)
    yield from (("iban", *m.span()) for m in _IBAN.finditer(text) if _iban_ok(m[0]))
    if "-" in text:
        yield from (("ssn", *m.span()) for m in _SSN.finditer(text) if _ssn_ok(m))
    yield from (("birth", *m.span()) for m in _BIRTH.finditer(text) if _birth_ok(m))


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's own value, raised or lowered by words within ``AROUND`` code points."""
    near = {w.lower() for w in _WORD.findall(text[max(0, start - AROUND):start] + " " + text[end:end + AROUND // 2])}
    value = _START[kind] + (0.35 if near & _HINTS[kind] else 0) - (0.25 if near & _DOUBTS else 0)
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every span that is kept, by kind as listed, then start."""
    found = [(k, a, b, score(text, k, a, b)) for k, a, b in _proposals(text)]
    return [f for f in found if f[0] in BASE or f[3] >= KEEP]


def pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (list of kind, start, end, score)."""
    df = id_text(docs, id_col, text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(part: pa.RecordBatch) -> dict:
        rows = [[dict(zip(("kind", "start", "end", "score"), f)) for f in find(t)] for t in as_text(part["text"])]
        return {"doc_id": part["doc_id"], "spans": pa.array(rows, pa.list_(span))}

    return map_batches(df, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, "
                                "spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def op1_pii(docs: DataFrame) -> DataFrame:
    found = pii(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(F.concat_ws(",", F.transform(base, shown)).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", shown)).alias("spans"),
        F.concat_ws(",", F.transform("spans", lambda s: s["score"].cast("string"))).alias("scores"))
