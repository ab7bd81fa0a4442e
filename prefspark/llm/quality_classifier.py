"""A generalised additive model with pairwise interactions for text quality.

Cyclic boosting visits one feature after another and fits a shallow tree to the residuals; all
trees of a feature add up to one table with a value per bin. Then the pairs of features that
explain most of what is left get a table each in the same way. A document's score is the sum
of one table entry per feature and pair, so scoring is vectorised lookup and addition.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, documents_of, map_batches, slices
from prefspark.storage import durable

#: Most labelled rows the model is fitted on, taken by the least hashes of their ids.
SAMPLE_ROWS = 40_000
BINS = 64
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 60
PAIR_ROUNDS = 30
LEARNING_RATE = 0.2
LEAVES = 4
LEAST_WEIGHT = 2.0
SHRINK = 1.0

FEATURES = (
    "log_words", "word_length", "longest_word", "upper_share", "digit_share", "symbol_share", "mark_share",
    "stop_share", "distinct_share", "top_word_share", "repeated_pairs", "log_lines", "repeated_lines",
    "line_words", "ended_lines", "short_words", "upper_words", "marked_words", "joiner_share",
)

VALUES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))])
SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])

_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_MARKS = b"!?;:\"'()[]{}~^_=+/\\@`"
_JOINERS = re.compile(rb"(?:^| )[|+*=<>~-]+(?= |$)", re.MULTILINE)


def text_features(text: str | None) -> list[float]:
    """The values of ``FEATURES``; an empty text has zeros."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(raw)
    counted = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    share = lambda kind: (size - len(raw.translate(None, kind))) / size
    upper = sum(1 for w in counted.elements() if w[:2].isupper() and len(w) > 1)
    marked = sum(c for w, c in counted.items() if w[-1] in b"!#*$%&|<>")
    return [
        float(np.log1p(n)),
        len(raw.translate(None, b" \t\r\n\x0b\x0c")) / n,
        float(min(200, max(map(len, counted)))),
        share(_UPPER),
        share(_DIGITS),
        share(_SYMBOLS),
        share(_MARKS),
        share(b".,"),
        len(counted) / n,
        max(counted.values()) / n,
        1 - len(pairs) / max(1, n - 1),
        float(np.log1p(len(lines))),
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / len(lines),
        sum(c for w, c in counted.items() if len(w) <= 3) / n,
        upper / n,
        marked / n,
        len(_JOINERS.findall(raw)) / n,
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """``doc_id, features`` of every whole text."""
    schema = arrow_schema(VALUES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [text_features(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(values, schema.field(1).type)], schema=schema)

    rows = documents_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, measure, VALUES)


@dataclass
class AdditiveModel:
    """Bin edges and value tables; ``pairs`` lists which features a pair table is for."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logits(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.bias)
        for i, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, values[:, i], "right")]
        coarse = {i: np.searchsorted(self.pair_edges[i], values[:, i], "right") for p in self.pairs for i in p}
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[i], coarse[j]]
        return total

    def scores(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(values), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Distinct quantiles; a value equal to an edge falls above it."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray | float, h: np.ndarray | float) -> np.ndarray | float:
    return g * g / (h + SHRINK)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Step per bin of a tree with up to ``leaves`` leaves over ordered bins."""
    step = np.zeros(len(g))
    parts = [(0, len(g))]

    def best(part: tuple[int, int]) -> tuple[float, int]:
        lo, hi = part
        if hi - lo < 2:
            return 0.0, lo
        gs, hs = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        gl, hl = gs[:-1], hs[:-1]
        gain = _gain(gl, hl) + _gain(gs[-1] - gl, hs[-1] - hl) - _gain(gs[-1], hs[-1])
        gain[(hl < LEAST_WEIGHT) | (hs[-1] - hl < LEAST_WEIGHT)] = 0
        at = int(np.argmax(gain))
        return float(gain[at]), lo + at + 1

    while len(parts) < leaves:
        cuts = [(*best(p), p) for p in parts]
        gain, at, part = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove(part)
        parts += [(part[0], at), (at, part[1])]
    for lo, hi in parts:
        step[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + SHRINK)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A cut along one axis, then a cut along the other in each half; its step and gain."""
    chosen, most = np.zeros(g.shape), -1.0
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        left_g, left_h = np.cumsum(a, 0)[:-1], np.cumsum(b, 0)[:-1]
        for at in range(len(left_g)):
            step, gain = np.zeros(a.shape), 0.0
            for rows, gg, hh in (
                (slice(0, at + 1), left_g[at], left_h[at]),
                (slice(at + 1, None), a.sum(0) - left_g[at], b.sum(0) - left_h[at]),
            ):
                own = _tree(gg, hh, 2)
                step[rows] = own
                gain += float(np.sum(own * gg - 0.5 * own * own * hh))
            if gain > most:
                most, chosen = gain, step if axis == 0 else step.T
    return chosen, most


def fit_model(values: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Fit on rows of features and 0/1 labels; without rows the model says one half."""
    count = values.shape[1] if values.ndim == 2 else len(FEATURES)
    n = len(labels)
    if not n:
        return AdditiveModel(0.0, [np.empty(0)] * count, [np.zeros(1)] * count, [np.empty(0)] * count, [], [])
    rate = (labels.sum() + 0.5) / (n + 1)
    edges = [_edges(values[:, i], BINS) for i in range(count)]
    bins = [np.searchsorted(e, values[:, i], "right") for i, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    bias = float(np.log(rate / (1 - rate)))
    logit = np.full(n, bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i in range(count):
            g, h = slopes()
            size = len(tables[i])
            step = LEARNING_RATE * _tree(np.bincount(bins[i], g, size), np.bincount(bins[i], h, size), LEAVES)
            tables[i] += step
            logit += step[bins[i]]
    pair_edges = [_edges(values[:, i], PAIR_BINS) for i in range(count)]
    coarse = [np.searchsorted(e, values[:, i], "right") for i, e in enumerate(pair_edges)]

    def histograms(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        shape = (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)
        cell = coarse[i] * shape[1] + coarse[j]
        return tuple(np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (g, h))

    gains = [(_pair_tree(*histograms(i, j))[1], (i, j)) for i, j in combinations(range(count), 2)]
    pairs = [p for gain, p in sorted(gains, reverse=True)[:PAIRS] if gain > 1e-9]
    pair_tables = [np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(pairs):
            step = LEARNING_RATE * _pair_tree(*histograms(i, j))[0]
            pair_tables[k] += step
            logit += step[coarse[i], coarse[j]]
    return AdditiveModel(bias, edges, tables, pair_edges, pairs, pair_tables)


def is_held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned; a null id has none to learn."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The model is fitted on at most ``sample_rows`` labelled rows that aren't held out; more
    rows would hardly move tables of this size. Rows with a null label or id are not learned
    from. A null or empty text is scored like any other, by zero features. Without any label
    every score is 0.5. Repeated rows get equal scores; other columns are not read.
    """
    table = durable(feature_table(docs))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    # Repeated documents repeat their features: one row for each label is learned from.
    rows = table.join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min("features").alias("features"))
    learned = rows.orderBy("doc_id", "quality").limit(sample_rows).toPandas()
    values = np.array(learned["features"].tolist(), float).reshape(len(learned), len(FEATURES))
    model = fit_model(values, learned["quality"].to_numpy(float))
    schema = arrow_schema(SCORES)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
                yield pa.record_batch([batch.column(0), pa.array(model.scores(rows))], schema=schema)

    scored = map_batches(table, score, SCORES)
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
