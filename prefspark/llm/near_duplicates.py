"""Near duplicates by banded MinHash, with odd sketches between candidates and full sets.

Documents with equal shingle sets are one class, and only classes are compared. Bands of
MinHash values propose candidates. An odd sketch folds all MinHash samples of a class into a
parity bitmap; the population count of two bitmaps' XOR estimates a high similarity well, so
it rules out nearly all false candidates before full sets are compared. A second bitmap folds
the shingles themselves: the population count of an XOR never exceeds the number of shingles
that only one of the sets has, so it rules out pairs just below the threshold and loses no link.

No group is expanded into all its pairs. Each bucket first links its members to one pivot;
linked classes form components, and only pairs across components are still open. Buckets with
many open pairs try more pivots, and what then is left is compared pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, documents_of, first_row_id, map_batches, sent_if_small, slices
from prefspark.storage import durable

ROWS = 7
BANDS = 44  # at similarity 0.8, three of 100,000 pairs share no band; at 0.85, none in 10 million
SAMPLES = ROWS * BANDS
SKETCH_BITS = 512
#: Bits of the bitmap of whole sets; sets of a few thousand shingles fill it, and it then rules out little.
SET_BITS = 1024
#: How far an estimate may lie below the threshold: over five standard errors.
MARGIN = 0.16
#: Words whose hashes a Python worker remembers; on reaching it, the memory starts anew.
MEMORY = 200_000
#: Bands whose pivots are tried first; the others only see what those leave open.
FIRST_BANDS = 6
PIVOT_ROUNDS = 1

SIGNATURES = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_hash", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
)
SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``size`` words.

    Fewer words, but not none, are one shingle.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, _U)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], _U)
    values = np.array(itemgetter(b"", *words)(_HASHES), _U)[1:]
    count = len(values) - size + 1
    shingles = values[:count].copy()
    for i in range(1, size):
        shingles = shingles * _MIX + values[i : i + count]
    return np.unique(_mixed(shingles))


_NUMBERS = _mixed(np.arange(1, 3 * SAMPLES + 1, dtype=_U) * _MIX)
_FACTORS = ((_NUMBERS[:SAMPLES] >> _U(32)) | _U(1)).astype(np.uint32)[:, None]
_OFFSETS = (_NUMBERS[SAMPLES : 2 * SAMPLES] >> _U(32)).astype(np.uint32)[:, None]
_SALTS = _NUMBERS[2 * SAMPLES :]


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    values = (shingles >> _U(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), 256):
        np.minimum(least, (_FACTORS * values[at : at + 256] + _OFFSETS).min(axis=1), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.astype(_U).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=_U)
    for i in range(ROWS):
        key = _mixed(key * _MIX + rows[:, i])
    return key.view(np.int64)


def _parities(values: np.ndarray, bits: int) -> np.ndarray:
    """Parities of the values that fall on each bit, as signed 64-bit words."""
    parity = np.bincount((values % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Bitmap of a set's MinHash samples, each with its number."""
    return _parities(_mixed(samples.astype(_U) + _SALTS), SKETCH_BITS)


def set_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bitmap of a set's shingles."""
    return _parities(shingles, SET_BITS)


def most_odd_bits(similarity: float, margin: float = MARGIN) -> int:
    """XOR population count up to which the estimate is at least ``similarity - margin``.

    The estimate is ``1 + bits / (4 * samples) * ln(1 - 2 * count / bits)``.
    """
    low = similarity - margin
    return math.floor(SKETCH_BITS / 2 * (1 - math.exp((low - 1) * 4 * SAMPLES / SKETCH_BITS)))


def signatures(docs: DataFrame, size: int, row: str | None = None) -> DataFrame:
    """Stored signatures, one row per document; ``row`` names a column of row numbers, if there is one."""
    schema = arrow_schema(SIGNATURES)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = first_row_id()
        for batch in slices(batches):
            rows = []
            for doc_id, text, number in zip(*(c.to_pylist() for c in batch.columns)):
                own = row_id if row is None else number
                shingles = shingle_set(text, size)
                if len(shingles):
                    samples = min_hashes(shingles)
                    digest = xxhash.xxh3_128_digest(shingles.tobytes())
                    rows.append((own, doc_id, len(shingles), digest, band_keys(samples), np.r_[odd_sketch(samples), set_sketch(shingles)]))
                else:
                    rows.append((own, doc_id, 0, None, None, None))
                row_id += 1
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    number = F.lit(None).cast("long") if row is None else docs[row]
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], number.alias("number"))
    return durable(map_batches(rows, sign, SIGNATURES))


def _sets_of(docs: DataFrame, active: DataFrame, size: int, row: str | None) -> DataFrame:
    """Stored full shingle sets of the ``active`` classes (``node, class_doc, set_hash``)."""
    schema = arrow_schema(SETS)

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes, found = [], []
            for node, digest, text in zip(*(c.to_pylist() for c in batch.columns)):
                shingles = shingle_set(text, size)
                # Rows that repeat a doc_id with another text belong to another class.
                if xxhash.xxh3_128_digest(shingles.tobytes()) == digest:
                    nodes.append(node)
                    found.append(shingles.view(np.int64))
            yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(found, schema.field(1).type)], schema=schema)

    wanted = sent_if_small(durable(active.select("node", "class_doc", "set_hash")), 64)
    if row is None:
        texts = documents_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
        same = texts["doc_id"].eqNullSafe(wanted["class_doc"])
    else:  # a class's node is the number of one of its rows
        texts = documents_of(docs, row, "text")
        same = texts[row] == wanted["node"]
    joined = texts.join(wanted, same).select("node", "set_hash", "text")
    return durable(map_batches(joined, shingle, SETS))


def _alike(similarity_pct: int) -> Column:
    """Whether two candidates' sizes and sketches (``n_a, n_b, sketch_a, sketch_b``) allow a link."""

    def odd(first: int, bits: int) -> Column:
        words = range(first // 64, (first + bits) // 64)
        return sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in words), F.lit(0))

    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    # In sets of similarity s, a share (1 - s) / (1 + s) of both sizes' sum is in one set only.
    apart = (100 + similarity_pct) * odd(SKETCH_BITS, SET_BITS) <= (100 - similarity_pct) * (F.col("n_a") + F.col("n_b"))
    return (100 * small >= similarity_pct * large) & (odd(0, SKETCH_BITS) <= most_odd_bits(similarity_pct / 100)) & apart


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity_pct: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return pairs.join(b, "b").join(a, "a").where(100 * both >= similarity_pct * union).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every linked node; the label is the least node of its component.

    Each step takes the least label among neighbours and then the label of that label, so
    steps grow with the logarithm of a component's diameter.
    """
    both = durable(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    )
    labels = durable(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("seen"))
        nearer = labels.join(near, labels["node"] == near["u"]).select(
            "node", F.col("label").alias("old"), F.least("label", "seen").alias("via")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        stepped = durable(nearer.join(jump, "via").select("node", "old", F.least("via", "next").alias("label")))
        changed = stepped.where("label <> old").limit(1).count()
        labels = stepped.select("node", "label")
        if not changed:
            return labels


def near_duplicates(docs: DataFrame, size: int = 5, similarity_pct: int = 80, row: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if ``100 * intersection >= similarity_pct * union`` of their sets of
    ``size``-word shingles. ``component_id`` is the least ``doc_id`` reachable by links, and
    ``kept`` marks the document it names. A null or empty text, or one without words, has no
    shingles, is linked with nothing and is kept. Repeated rows belong to one component and
    share ``kept``. A null ``doc_id`` never names a component that has another id. Other
    columns are not read; an empty table gives an empty result.

    If ``row`` names a column of unique row numbers, the result has it too, and ``first`` marks
    exactly one row of each component, the one of the least ``doc_id``, then the least number,
    null ids last. A row without shingles is ``first``.
    """
    signed = signatures(docs, size, row)
    foremost = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    classes = durable(
        signed.where("n_shingles > 0")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("class_doc"), F.min("row_id").alias("node"), foremost.alias("foremost"))
    )
    labels = _labels(docs, signed, classes, size, similarity_pct, row)
    labelled = classes.join(labels, "node", "left").select(
        "set_hash", "class_doc", "foremost", F.coalesce("label", "node").alias("label")
    )
    named = labelled.groupBy("label").agg(F.min("class_doc").alias("component_doc"), F.min("foremost")["row_id"].alias("first_row"))
    members = labelled.join(named, "label").select("set_hash", "component_doc", "first_row")
    rows = signed.select("row_id", "doc_id", "n_shingles", "set_hash").join(members, "set_hash", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_doc")).otherwise(F.col("doc_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    named_rows = rows.withColumn("component_id", component).withColumn("kept", kept)
    first = F.coalesce(F.col("row_id") == F.col("first_row"), F.lit(True))
    more = [] if row is None else [F.col("row_id").alias(row), first.alias("first")]
    return named_rows.select("doc_id", "n_shingles", "component_id", "kept", *more)


def _labels(docs: DataFrame, signed: DataFrame, classes: DataFrame, size: int, similarity_pct: int, row: str | None) -> DataFrame:
    """``node, label`` of the classes that are linked with another one."""
    nodes = signed.join(classes.select(F.col("node").alias("row_id")), "row_id", "left_semi")
    banded = nodes.select(F.col("row_id").alias("node"), F.posexplode("keys").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.min("node").alias("pivot"), F.max("node").alias("_last")).where("_last <> pivot")
    buckets = durable(banded.join(shared.select("band", "key", "pivot"), ["band", "key"]))

    sketches = signed.select(F.col("row_id").alias("node"), F.col("n_shingles").alias("n"), "sketch")
    sketches = durable(sketches.join(buckets.select("node").distinct(), "node", "left_semi"))

    def proposed(pairs: DataFrame) -> DataFrame:
        """Distinct pairs that sizes and sketches allow."""
        a, b = (sketches.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
        return durable(pairs.distinct().join(b, "b").join(a, "a").where(_alike(similarity_pct)).select("a", "b"))

    pairs = proposed(buckets.where((F.col("band") < FIRST_BANDS) & (F.col("node") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    # Any class that may ever be confirmed shares a bucket, but not all of those have a likely partner.
    active = classes.join(sketches.select("node"), "node", "left_semi")
    sets = _sets_of(docs, active, size, row)
    links = durable(_confirmed(pairs, sets, similarity_pct))
    labels = components(links)
    for turn in range(PIVOT_ROUNDS + 1):
        found = buckets.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
        groups = durable(found.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node")).alias("one")))
        per_key = groups.groupBy("key").agg(
            F.sum("m").alias("members"),
            F.sum(F.col("m") * F.col("m")).alias("within"),
            F.max(F.struct("m", "label", "one")).alias("largest"),
        )
        mixed = durable(per_key.withColumn("open", (F.col("members") * F.col("members") - F.col("within")) / 2).where("open > 0"))
        total = mixed.agg(F.sum("open").alias("open"), F.sum("members").alias("members")).first()
        if not total.open:
            break
        found = durable(found.join(mixed.select("key", "largest"), "key"))
        last = turn == PIVOT_ROUNDS or total.open <= 4 * total.members
        if last:
            rows = found.select("key", "node", "label").join(sketches, "node")
            a, b = (rows.select("key", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "label", "n", "sketch"))) for x in "ab")
            across = a.join(b, "key").where((F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & _alike(similarity_pct))
            pairs = durable(across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
        else:
            pivot = F.col("largest.one.node").alias("a")
            pairs = proposed(found.where(F.col("label") != F.col("largest.label")).select(pivot, F.col("node").alias("b")))
        more = durable(_confirmed(pairs, sets, similarity_pct))
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)
        if last:
            break
        buckets = found.select("key", "node")  # only open buckets are looked at again
    return labels
