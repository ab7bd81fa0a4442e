"""Secrets, and multipart credentials linked by an interval join within scopes.

Strong candidates are reported alone. Weak ones (an identifier, a bare key-like string of 32
or more base64 or url-safe characters with its padding, an endpoint) are reported only where
complementary parts lie in one block of one document: the text between blank lines, of any
length. A scope never crosses documents, so the join runs inside a row: block starts are
sorted, and a binary search gives each part its block.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, documents_of, map_batches, slices

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "identifier", "bare_secret", "endpoint")
#: Parts of one credential lie in one block: text between blank lines.
_BLOCK_BREAK = re.compile(r"\n[\x20\t\r]*\n")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("links", T.LongType()),
    ]
)
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))])

# Patterns of the base kinds.
_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal: a run that is long enough matches from its start
_ASSIGN_WORDS = ("passw", "secret", "token", "api")

# Weak parts, by role.
_IDENTIFIER = re.compile(
    r"""(?i:client_?id|account_?id|access_?key_?id|user_?name|login|user)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    re.ASCII,
)
# Standard and url-safe base64 of any length from 32, with its padding.
_BARE_SECRET = re.compile(r"(?<![A-Za-z0-9/+=_-])[A-Za-z0-9/+_-]{32,}={0,2}(?![A-Za-z0-9/+=_-])")
_ENDPOINT = re.compile(r"""(?:https?|postgres|postgresql|mysql|mongodb|redis|amqp|amqps|ftp|s3)://[^\s"'<>]{3,}""")
_ROLE = {"assign": "secret", "hex": "secret", "bare_secret": "secret", "access": "id", "identifier": "id", "endpoint": "endpoint"}


def _base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    lowered = text.lower()
    if any(w in lowered for w in _ASSIGN_WORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _weak_spans(text: str) -> Iterator[tuple[str, int, int]]:
    if ":" in text or "=" in text:
        for m in _IDENTIFIER.finditer(text):
            yield "identifier", m.start(), m.end()
    for m in _BARE_SECRET.finditer(text):
        value = m[0]
        if any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value):
            yield "bare_secret", m.start(), m.end()
    if "://" in text:
        for m in _ENDPOINT.finditer(text):
            yield "endpoint", m.start(), m.end()


class _Blocks:
    """Numbers of the blocks (text between blank lines) that spans touch."""

    def __init__(self, text: str):
        self.starts = [m.end() for m in _BLOCK_BREAK.finditer(text)]

    def of(self, start: int, end: int) -> range:
        return range(bisect_right(self.starts, start), bisect_right(self.starts, max(start, end - 1)) + 1)


class _Intervals:
    """Sorted intervals, with how far any of the first ones reaches."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        ordered = sorted((start, end) for _, start, end in spans)
        self.starts = [s for s, _ in ordered]
        self.reach: list[int] = []
        for _, end in ordered:
            self.reach.append(max(end, self.reach[-1]) if self.reach else end)

    def near(self, start: int, end: int, scope: int = 0) -> bool:
        """Whether an interval lies within ``scope`` characters of this one."""
        before = bisect_right(self.starts, end + scope)
        return before > 0 and self.reach[before - 1] >= start - scope


def secret_spans(text: str | None) -> list[tuple[str, int, int, int]]:
    """``kind, start, end, links`` by start, then kind as in ``KINDS``; code points, end exclusive.

    ``links`` is the number of complementary roles in the span's block (the text between blank
    lines, however long). Base kinds are always reported; a weak secret needs an identifier,
    an identifier a secret, an endpoint both. Weak spans that overlap a span of their own role
    are left out.
    """
    if not text:
        return []
    base = list(_base_spans(text))
    weak = list(_weak_spans(text))
    by_role: dict[str, list[tuple[str, int, int]]] = {"id": [], "secret": [], "endpoint": []}
    for span in base:
        by_role[_ROLE[span[0]]].append(span)
    strong = {role: _Intervals(spans) for role, spans in by_role.items()}
    weak = [s for s in weak if not strong[_ROLE[s[0]]].near(s[1] + 1, s[2] - 1, 0)]
    for span in weak:
        by_role[_ROLE[span[0]]].append(span)
    blocks = _Blocks(text)
    held = {role: {b for _, s, e in spans for b in blocks.of(s, e)} for role, spans in by_role.items()}
    found = []
    for kind, start, end in base + weak:
        mine = blocks.of(start, end)
        others = {role for role in by_role if role != _ROLE[kind] and any(b in held[role] for b in mine)}
        asked = {"identifier": {"secret"}, "bare_secret": {"id"}, "endpoint": {"id", "secret"}}.get(kind, set())
        if asked <= others:
            found.append((kind, start, end, len(others)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and its spans with their links.

    A null or empty text has no spans, repeated rows have equal ones, a null ``doc_id`` stays
    null and other columns are not read. Nothing is shuffled.
    """
    schema = arrow_schema(FOUND)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [[dict(zip(SPAN.names, s)) for s in secret_spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(spans, schema.field(1).type)], schema=schema)

    rows = documents_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, find, FOUND)
