"""Token counts by heap-and-linked-list byte-pair merging, without emitting ids.

A pre-token of ``n`` bytes starts as ``n`` linked symbols. The adjacent pair of the lowest
rank is popped from a heap and merged, again and again; each merge makes one symbol out of
two, so the count is ``n`` minus the merges made.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, documents_of, map_batches, slices
from prefspark.llm.tokenization import byte_letters

#: Fixed value: the pre-tokens of the byte-level tokenizer.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces a Python worker remembers; on reaching it, the memory starts anew.
MEMORY = 600_000

COUNTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def merge_ranks(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """Rank of each mergeable pair, and the special strings, of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = {letter: byte for byte, letter in byte_letters().items()}
    plain = lambda s: bytes(letters[c] for c in s)
    merges = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
    ranks = {(plain(a), plain(b)): rank for rank, (a, b) in enumerate(merges)}
    return ranks, [t["content"] for t in content.get("added_tokens", [])]


def count_merged(word: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left when no adjacent pair has a rank any more."""
    n = len(word)
    symbols: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two was merged meanwhile
        merges += 1
        symbols[i], symbols[j] = left + right, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            rank = ranks.get((symbols[i], symbols[after[i]]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[after[i]]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
    return n - merges


class _Unclear(Exception):
    """A piece begins or ends in white space, so it can't be counted alone."""


class _Pieces(dict):
    """Counts of pieces between single spaces, each with ``lead`` before it."""

    def __init__(self, counter: TokenCounter, lead: str):
        super().__init__()
        self._counter, self._lead = counter, lead

    def __missing__(self, piece: str) -> int:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Unclear
        if len(self) >= self._counter.memory:
            self.clear()
        self[piece] = count = self._counter.matched(self._lead + piece)
        return count


class TokenCounter:
    """Token counts of whole texts for one byte-level tokenizer file."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.memory = memory
        self._ranks, special = merge_ranks(path)
        self._pattern = regex.compile(PRE_TOKENS)
        self._special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or "(?!)")
        self._words: dict[str, int] = {}
        self._first, self._inner = _Pieces(self, ""), _Pieces(self, " ")

    def matched(self, text: str) -> int:
        """Count by the pattern, for any text without special strings."""
        total = 0
        for word in self._pattern.findall(text):
            count = self._words.get(word)
            if count is None:
                if len(self._words) >= self.memory:
                    self._words.clear()
                count = self._words[word] = count_merged(word.encode(), self._ranks)
            total += count
        return total

    def _part(self, text: str) -> int:
        if not text:
            return 0
        try:
            # A lone space belongs to the word after it, and a lone line feed is one token.
            lines = text.split("\n")
            total = (len(lines) - 1) * self.matched("\n")
            for line in lines:
                first, *rest = line.split(" ")
                total += self._first[first] + (sum(itemgetter(*rest)(self._inner)) if len(rest) > 1 else sum(self._inner[r] for r in rest))
            return total
        except _Unclear:
            return self.matched(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self._special.split(text)
        return len(parts) - 1 + sum(map(self._part, parts))


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``path`` is the file of a byte-level tokenizer. Special strings count as one token, as the
    library does it. A null or empty text has no bytes and no tokens. Nothing is shuffled: a
    row's result depends on its text only, so repeated rows get equal results, a null
    ``doc_id`` stays null and other columns are not read.
    """
    schema = arrow_schema(COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = TokenCounter(path)
        counter = _COUNTERS[path]
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            sizes = [len(t.encode()) if t else 0 for t in texts]
            tokens = [counter.count(t) for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], schema=schema)

    counted = map_batches(documents_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text"), count, COUNTS)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
