"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Method:

1. Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of the texts, A-Z lower-cased; for the
   seeded deletion rule see :func:`words_of`. The vocabulary keeps distinct words of at least
   ``min_length`` code points seen ``min_count`` times or more (counted per task first).
2. Index: the vocabulary of one length ``L`` is dealt to blocks of about ``target_block`` words,
   twice: by its first ``L // 2`` letters and by the others. A block keeps, per (position,
   letter), a bitset over its words: bit ``t`` is set when word ``t`` has that letter there.
3. Search: every word of length ``L`` (replacement) or ``L - 1`` (insertion) is a query of the
   blocks of length ``L`` that hold one of its halves: one edit leaves a half of the target
   intact, so no near pair is lost, and a word meets four blocks however many there are.
   Queries go in blocks of ``query_block``, one group per (target block, query block). For all queries of a task at once, word-parallel recurrences run position by
   position: for replacement ``E1 = (E1 & M) | (E0 & ~M); E0 &= M`` with ``M`` the bitset of the
   query's letter there; for insertion the one-error set reads the query's letter one position
   back (``A1 = (A1 & B[j][q[j-1]]) | A0; A0 &= B[j][q[j]]``). The zero-error and one-error sets
   are tracked together; the one-error set at the end is the near words. A near pair of
   different lengths is found from the shorter word and recorded both ways.
4. Forms: a word's form is its near word of largest ``n`` (ties: smallest in code-point order)
   if that ``n`` is at least twice its own; roots follow forms to the end by pointer jumping
   (``n`` at least doubles along a chain, so chains are short).

Defined cases: a null text has no runs; a null ``doc_id`` gives no deletion (the hash is
undefined); empty tables give no rows; repeated rows count as often as they occur; very long
runs are words like any other; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import map_batches, sent_if_small, ship_library, slices
from prefspark.storage import durable

# Fixed values of the contract: the letters of a run as Latin-1 bytes, A-Z lower-cased, others a space; the deletion divisor.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
DIVISOR = 97

#: Distinct words a task counts before it passes the counts on.
MEMORY = 300_000

#: Words of one length in one index block, and queries met in one task: bound a task's memory.
TARGET_BLOCK = 8192
QUERY_BLOCK = 4096

COUNTS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
PAIRS = T.StructType([T.StructField("word", T.StringType()), T.StructField("other", T.StringType())])


def _kept(run: bytes, start: int) -> str:
    """The word of a lower-cased Latin-1 run after the seeded deletion; ``start`` is the crc32 of ``<doc_id>:``."""
    word = run.decode("latin-1")
    h = zlib.crc32(run if word.isascii() else word.encode(), start)
    if h % DIVISOR:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def words_of(docs: DataFrame) -> DataFrame:
    """Words after lower-casing and the seeded deletion with their counts, each counted in part.

    ``h`` is the unsigned crc32 of UTF-8 ``<doc_id>:<run>``; when 97 divides it, the run loses
    its code point ``h % length``. A task counts at most ``MEMORY`` words before it passes them on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in slices(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                # One byte per code point, "?" for those past U+00FF; all but the letters become spaces.
                runs = Counter((text or "").encode("latin-1", "replace").translate(LETTERS).split())
                if doc_id is None:
                    for run, n in runs.items():
                        total[run.decode("latin-1")] += n
                else:
                    start = zlib.crc32(f"{doc_id}:".encode())
                    for run, n in runs.items():
                        total[_kept(run, start)] += n
            if len(total) >= MEMORY:
                yield counted()
                total.clear()
        yield counted()

    return map_batches(docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"].alias("text")), count, COUNTS)


def vocabulary(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    counted = words_of(docs).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.length("word") >= min_length) & (F.col("n") >= min_count)).withColumn("size", F.length("word"))


def _codes(words: list[str], size: int) -> np.ndarray:
    out = np.zeros((len(words), size), dtype=np.int32)
    for i, w in enumerate(words):
        out[i, : len(w)] = [ord(c) for c in w]
    return out


def near_in_block(targets: list[str], queries: list[str]) -> list[tuple[str, str]]:
    """(query, target) pairs one edit apart, for targets of one length and queries one shorter or as long."""
    if not targets or not queries:
        return []
    size = len(targets[0])
    count, width = len(targets), (len(targets) + 63) // 64
    codes = _codes(targets, size)
    letters = np.unique(codes)
    slot = np.full(256, len(letters), dtype=np.int64)  # letters the block lacks have an empty bitset
    slot[letters] = np.arange(len(letters))
    index = np.zeros((size, len(letters) + 1, width), dtype=np.uint64)
    bit = np.left_shift(np.uint64(1), (np.arange(count) % 64).astype(np.uint64))
    for pos in range(size):
        np.bitwise_or.at(index[pos], (slot[codes[:, pos]], np.arange(count) // 64), bit)
    last = np.full(width, ~np.uint64(0), dtype=np.uint64)
    if count % 64:
        last[-1] = np.uint64((1 << (count % 64)) - 1)
    found = []
    for length in (size, size - 1):
        mine = [q for q in queries if len(q) == length]
        if not mine:
            continue
        q = slot[_codes(mine, length)] if length else np.zeros((len(mine), 0), dtype=np.int64)
        zero = np.broadcast_to(last, (len(mine), width)).copy()
        one = np.zeros_like(zero)
        for j in range(size):
            if length == size:  # replacement: one position may differ
                m = index[j][q[:, j]]
                one = (one & m) | (zero & ~m)
                zero &= m
            else:  # insertion: the target's letter j is extra, or matches the query's letter j - 1
                back = index[j][q[:, j - 1]] if j else np.zeros_like(zero)
                one = (one & back) | zero
                zero = zero & index[j][q[:, j]] if j < length else np.zeros_like(zero)
        rows, words = np.nonzero(one)
        for r, wd in zip(rows, words):
            bits = int(one[r, wd])
            while bits:
                low = bits & -bits
                found.append((mine[r], targets[wd * 64 + low.bit_length() - 1]))
                bits ^= low
    return found


def _searcher(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    pairs = near_in_block(sorted(data["word"].tolist()), queries["word"].tolist())
    rows = pairs + [(b, a) for a, b in pairs if len(a) != len(b)]
    return pd.DataFrame(rows, columns=["word", "other"])


def _keyed(word: Column, size: Column, cut: Column, length: Column) -> Column:
    """The intact halves by which ``word``, of ``length`` letters, meets targets of ``size`` letters.

    Targets are cut after ``size // 2`` letters. A word one edit away keeps all letters before
    the cut, or all behind it; a shorter one has those behind it a place earlier.
    """
    head, tail = F.substring(word, F.lit(1), cut), F.substring(word, cut + 1 + length - size, length)
    return F.explode(F.array(F.struct(F.lit(0).alias("side"), head.alias("half")), F.struct(F.lit(1).alias("side"), tail.alias("half"))))


def near_pairs(vocab: DataFrame, target_block: int = TARGET_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Ordered pairs (word, other) of vocabulary words one edit apart; each pair both ways."""
    cells = vocab.groupBy("size").agg(F.ceil(2 * F.count(F.lit(1)) / target_block).cast("int").alias("cells"))
    cells = durable(cells)  # one row per word length: its size is bounded by the longest word
    half = F.floor(F.col("size") / 2).cast("int")
    key = ["size", "side", "cell"]

    def dealt(words: DataFrame) -> DataFrame:
        """Words (``word, size``: of the targets) in the cells of both halves, half a block's targets each on average."""
        keyed = words.select("word", "size", _keyed(F.col("word"), F.col("size"), half, F.length("word")).alias("k")).select("word", "size", "k.*")
        return keyed.join(F.broadcast(cells), "size").select(
            "word", "size", "side", F.pmod(F.xxhash64("half"), F.col("cells")).cast("int").alias("cell")
        )

    as_target = dealt(vocab.select("word", "size"))
    as_query = dealt(vocab.select("word", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("size")))
    # Cells with more words than a block, as of a frequent half, are met block by block.
    plan = (
        as_target.select(*key, F.lit(1).alias("target"))
        .unionByName(as_query.select(*key, F.lit(0).alias("target")))
        .groupBy(*key)
        .agg(F.sum("target").alias("v"), F.sum(1 - F.col("target")).alias("u"))
        .where("v > 0 and u > 1")  # a lone target meets only itself
        .select(*key, F.ceil(F.col("v") / target_block).cast("int").alias("tb"), F.ceil(F.col("u") / query_block).cast("int").alias("qb"))
    )
    plan = sent_if_small(durable(plan), 32)
    # Keys of a cogroup must have one type on both sides: equal ints and longs hash to different partitions.
    targets = as_target.join(plan, key).select(
        "word", *key,
        F.pmod(F.xxhash64("word"), F.col("tb")).cast("int").alias("t"),
        F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"),
    )
    # Fresh names on the query side, so that both sides of the cogroup don't share columns.
    queries = as_query.withColumnRenamed("word", "query").join(plan, key).select(
        F.col("query").alias("word"), *key,
        F.explode(F.sequence(F.lit(0), F.col("tb") - 1)).alias("t"),
        F.pmod(F.xxhash64("query"), F.col("qb")).cast("int").alias("q"),
    )
    blocks = [*key, "t", "q"]
    ship_library(vocab.sparkSession)
    found = targets.groupBy(*blocks).cogroup(queries.groupBy(*blocks)).applyInPandas(_searcher, PAIRS)
    return found.distinct()


def spelling_variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2,
                      target_block: int = TARGET_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for every vocabulary word."""
    docs = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    vocab = durable(vocabulary(docs, min_length, min_count))
    pairs = durable(near_pairs(vocab, target_block, query_block))
    other = vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = pairs.join(other, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("neg"), F.col("other").alias("w"))).alias("b"),
    )
    forms = vocab.join(best, "word", "left").select(
        "word", "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.neg") >= ratio * F.col("n"), F.col("b.w")).alias("form"),
        F.when(-F.col("b.neg") >= ratio * F.col("n"), -F.col("b.neg")).cast("long").alias("form_n"),
    )
    forms = durable(forms)
    # Pointer jumping: each round replaces a word's pointer by its pointer's pointer.
    pointer = durable(forms.select("word", F.coalesce("form", "word").alias("root")))
    while True:
        ahead = pointer.select(F.col("word").alias("via"), F.col("root").alias("next"))
        stepped = durable(pointer.join(ahead, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        if not stepped.where("moved").limit(1).count():
            pointer = stepped.select("word", "root")
            break
        pointer = stepped.select("word", "root")
    return forms.join(pointer, "word").select("word", "form", "root", "n", "n_near", "form_n")
