"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, documents_of, map_batches, ship_library, slices

#: Kinds in the order of reports: those found by pattern and check alone, then those that context must support.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "local_phone")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))])

# Patterns of the base kinds, by parts where a plain search would retry long runs.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

# Lengths of international bank account numbers, by country of the register.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

#: Score of a span by its form alone, and words that raise it when they stand within ``WINDOW`` characters.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "national_id": 0.4, "local_phone": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "contact"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "national_id": ("ssn", "social", "security", "identity", "id"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "contact"),
}
WINDOW = 48
CONTEXT_GAIN = 0.3
#: Score from which a span of a kind outside ``BASE_KINDS`` is reported.
THRESHOLD = 0.6

_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As a search for the whole pattern finds them, but linear: the part before an @ is read backwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Numbers of their country's length; the search goes on where one ends, or behind the start that is none."""
    at = 0
    while m := _IBAN_START.search(text, at):
        start, end = m.span()
        at = start + 1
        length = IBAN_LENGTHS.get(m[0][:2], 0)
        seen = 4
        while seen < length:
            place = end + (text[end : end + 1] == " ")
            if text[place : place + 1] not in _IBAN_CHARACTERS:
                break
            end, seen = place + 1, seen + 1
        if length and seen == length and mod97(text[start:end].replace(" ", "")):
            yield start, end
            at = end


_IBAN_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def _more_spans(text: str) -> Iterator[tuple[str, int, int]]:
    if not _DIGIT.search(text):
        return
    for start, end in _ibans(text):
        yield "iban", start, end
    for kind, pattern in (("national_id", _NATIONAL_ID), ("local_phone", _LOCAL_PHONE)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]
    supported = not set(CONTEXT[kind]).isdisjoint(w.lower() for w in _WORD.findall(near))
    return round(min(1.0, SCORES[kind] + CONTEXT_GAIN * supported), 3)


def personal_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """``kind, start, end, score`` by kind as in ``KINDS``, then start; code points, end exclusive.

    Base kinds are always reported. Other kinds need a score of ``THRESHOLD`` and no overlap
    with a base span.
    """
    if not text:
        return []
    found = [(kind, start, end, _score(text, kind, start, end)) for kind, start, end in _base_spans(text)]
    taken = sorted((start, end) for _, start, end, _ in found)
    starts = [s for s, _ in taken]
    last = []  # how far any span up to this one reaches
    for _, end in taken:
        last.append(max(end, last[-1]) if last else end)
    for kind, start, end in _more_spans(text):
        before = bisect_left(starts, end)
        score = _score(text, kind, start, end)
        if score >= THRESHOLD and not (before and last[before - 1] > start):
            found.append((kind, start, end, score))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and its scored spans.

    A null or empty text has no spans, repeated rows have equal ones, a null ``doc_id`` stays
    null and other columns are not read. Nothing is shuffled.
    """
    schema = arrow_schema(FOUND)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [[dict(zip(SPAN.names, s)) for s in personal_spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(spans, schema.field(1).type)], schema=schema)

    rows = documents_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, find, FOUND)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def redacted(text: str | None) -> str | None:
    """The text with each span replaced by its kind; of overlapping spans the first names the gap."""
    spans = sorted(personal_spans(text), key=lambda s: (s[1], -s[2]))
    parts, done, gap = [], 0, None
    for kind, start, end, _ in spans:
        if gap is not None and start < done:
            done = max(done, end)
            continue
        parts += [text[done:start], f"<{kind.upper()}>"]
        done, gap = end, kind
    return "".join([*parts, text[done:]]) if spans else text


def redact_personal_data(docs: DataFrame) -> DataFrame:
    """The same rows and columns, with personal data in ``text`` replaced by ``<KIND>``."""
    ship_library(docs.sparkSession)
    place = docs.columns.index("text")

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = pa.array([redacted(t) for t in batch.column(place).to_pylist()], batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), column)

    return docs.mapInArrow(redact, docs.schema)
