"""Phrase collocations mined from depth-truncated suffix subtrees, built per prefix group.

Method (ERA-style vertical partitioning):

1. Texts are lower-cased (A-Z only), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into
   words ``[^\\x20\\x09]+``; all per language (null: ``und``).
2. Every word position starts a suffix; suffixes are truncated to ``depth`` words (the leaves
   of a suffix tree cut at that depth). A task numbers the words it meets, so that a leaf is
   one integer, and counts the same leaves before any shuffle. No leaf is stored.
3. Vertical partitioning: a leaf goes to the group of its first word, unless that prefix heads
   more than ``leaf_budget`` positions; then the prefix grows by a word, and so on. The
   prefixes that grow are at most (positions / budget) many per depth, so the set of them has
   a proven bound. Prefixes are packed into groups of about ``leaf_budget`` positions by a
   hash. A task sends a group one row per language: a list of words, and the leaves as places
   in that list.
4. Each group builds its subtree independently from its sorted leaves: a node is a run of equal
   prefixes, and its count is the sum of the leaf totals in it. Nodes at least as deep as their
   group's prefix are whole; shallower ones (only under grown prefixes) are partial and summed
   over groups by Spark.
5. Nodes of 1 to 3 words counted at least ``min_count`` times are the table ``f``; candidates
   are its nodes of 2 to 3 words. Every cut of a candidate after ``k`` words gives
   ``l = f(first part)``, ``r = f(rest)`` (both at least ``a``, so in the table) and the exact
   score ``floor(1000000 a^2 / (l r))`` in 38-digit decimals; the lowest cut counts, ties to
   the smallest ``k``. A candidate lying inside a longer candidate with
   ``100 f(longer) >= 50 a`` is dropped. Each language keeps its first ``top`` rows by score
   descending, ``a`` descending, phrase ascending (UTF-8 byte order).

Defined cases: a null text has no words; empty texts, empty pieces and tables without rows
give nothing; repeated rows count as often as they occur; a very long text only makes more
leaves (no word or text is cut); other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, map_batches, slices
from prefspark.storage import durable

# Fixed values of the contract: bytes that end a piece or a word, and the letters lower-cased. No UTF-8 text has the byte of BREAK.
BREAK = b"\xff"
BYTES = bytes(BREAK[0] if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Positions a prefix group may hold, distinct or not: bounds the memory of one subtree, some 100 bytes each.
LEAF_BUDGET = 500_000
#: Positions a task counts before it hands its leaves on, bytes of a text cut into words at once, words numbered at once.
POSITIONS = 2_000_000
#: Leaves of a task that are made into rows at once.
ROW_LEAVES = 250_000
WINDOW = 1 << 20
STEP = 1 << 14
#: A prefix is counted where it has more than this part of a task's positions; one of that part of all has it somewhere.
SHARE = 1 << 16

PREFIXES = T.StructType([T.StructField("lang", T.StringType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("n", T.LongType())])
BLOCKS = T.StructType(
    [
        T.StructField("group", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("words", T.ArrayType(T.BinaryType())),
        T.StructField("places", T.ArrayType(T.IntegerType())),
        T.StructField("totals", T.ArrayType(T.IntegerType())),
        T.StructField("keys", T.ArrayType(T.IntegerType())),
    ]
)
NODES = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("words", T.ArrayType(T.StringType())),
        T.StructField("f", T.LongType()),
        T.StructField("whole", T.BooleanType()),
    ]
)


class _Numbers(dict):
    """Numbers, from 1, of the words of one language as a task meets them; breaks between pieces are 0."""

    def __init__(self, lang: str, words: list):
        super().__init__({BREAK: 0})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = number = len(self.words)
        return number


def _tokens(text: bytes | None, depth: int) -> Iterator[list[bytes]]:
    """Lower-cased words and breaks of a text, a window at a time; ``depth - 1`` breaks end it.

    The last ``depth - 1`` tokens of a window come again in front of the next one.
    """
    spaced = (text or b"").translate(BYTES).replace(BREAK, b" " + BREAK + b" ")
    tokens, at = [], 0
    while at < len(spaced):
        end = spaced.find(b" ", at + WINDOW)
        end = len(spaced) if end < 0 else end
        tokens += spaced[at:end].split()
        if end < len(spaced) and len(tokens) >= depth:
            yield tokens
            tokens = tokens[1 - depth :] if depth > 1 else []
        at = end
    yield tokens + [BREAK] * (depth - 1)


class _Leaves:
    """The leaves of one task, as numbers: a leaf is its words' numbers side by side, 0 past its end."""

    def __init__(self, depth: int):
        self.depth, self.bits = depth, 63 // depth
        self.clear()

    def clear(self) -> None:
        self.words: list[tuple[str, bytes]] = []
        self.numbers: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.positions = 0

    def full(self, more: int) -> bool:
        return self.positions >= POSITIONS or len(self.words) + more >= 1 << self.bits

    def add(self, lang: str, tokens: list[bytes]) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(lang, self.words)
        ids = np.fromiter(map(self.numbers[lang].__getitem__, tokens), np.int64, len(tokens))
        own = len(ids) - self.depth + 1
        leaf, inside = ids[:own], ids[:own] > 0
        for i in range(1, self.depth):
            inside = inside & (ids[i : own + i] > 0)
            leaf = (leaf << self.bits) | np.where(inside, ids[i : own + i], 0)
        self.parts.append(leaf[ids[:own] > 0])
        self.positions += len(self.parts[-1])

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct leaves in order, and how often each occurs."""
        return np.unique(np.concatenate(self.parts), return_counts=True)

    def place(self, leaves: np.ndarray, i: int) -> np.ndarray:
        """Numbers of the leaves' words at place ``i``."""
        return (leaves >> (self.bits * (self.depth - 1 - i))) & ((1 << self.bits) - 1)


def _over_leaves(batches: Iterator[pa.RecordBatch], depth: int, emit) -> Iterator[pa.RecordBatch]:
    """``emit`` over the leaves of ``lang, text``, handed on when they are many."""
    leaves = _Leaves(depth)
    for batch in slices(batches):
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            for tokens in _tokens(text, depth):
                for at in range(0, len(tokens) - depth + 1, STEP):
                    part = tokens[at : at + STEP + depth - 1]
                    if leaves.positions and leaves.full(len(part)):
                        yield from emit(leaves)
                        leaves.clear()
                    leaves.add(lang, part)
    if leaves.positions:
        yield from emit(leaves)


def _map_leaves(docs: DataFrame, depth: int, emit, schema: T.StructType) -> DataFrame:
    lang = F.coalesce(docs["lang"], F.lit("und")).alias("lang")
    texts = docs.select(lang, F.make_valid_utf8(docs["text"]).cast("binary").alias("text"))
    return map_batches(texts, lambda batches: _over_leaves(batches, depth, emit), schema)


def _prefix_counts(depth: int):
    """Emit the counts of positions per language, and per prefix of less than ``depth`` words with a fair share of them."""
    schema = arrow_schema(PREFIXES)

    def emit(leaves: _Leaves) -> Iterator[pa.RecordBatch]:
        found, totals = leaves.counted()
        rows = []
        firsts = np.bincount(leaves.place(found, 0), totals, len(leaves.words) + 1).astype(np.int64)
        per_lang: Counter = Counter()
        for (lang, _), n in zip(leaves.words, firsts[1:].tolist()):
            per_lang[lang] += n
        rows += [(lang, None, n) for lang, n in per_lang.items()]
        for d in range(1, depth):
            inside = leaves.place(found, d) > 0
            heads = found[inside] >> (leaves.bits * (depth - d))
            if len(heads):
                starts = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
                sums = np.add.reduceat(totals[inside], starts)
                often = sums * SHARE > leaves.positions
                for head, n in zip(heads[starts][often].tolist(), sums[often].tolist()):
                    numbers = [(head >> (leaves.bits * (d - 1 - i))) & ((1 << leaves.bits) - 1) for i in range(d)]
                    words = [leaves.words[x - 1] for x in numbers]
                    rows.append((words[0][0], [w.decode() for _, w in words], n))
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return emit


def _dealt(depth: int, groups: int, grown: set[tuple]):
    """Emit one row per prefix group and language: its leaves, as places in the row's own list of words."""
    schema = arrow_schema(BLOCKS)

    def emit(leaves: _Leaves) -> Iterator[pa.RecordBatch]:
        found, totals = leaves.counted()
        numbers = [leaves.place(found, i).astype(np.int32) for i in range(depth)]
        hashes = np.array([0] + [xxhash.xxh64_intdigest(w, xxhash.xxh32_intdigest(lang)) for lang, w in leaves.words], np.uint64)
        key, hashed = np.ones(len(found), np.int8), hashes[numbers[0]]
        own = {w: i + 1 for i, w in enumerate(leaves.words)} if grown else {}
        for d in range(1, depth):
            heavy = [[own.get((lang, w)) for w in words] for lang, words in grown if len(words) == d]
            heads = np.array([sum(x << (leaves.bits * (d - 1 - i)) for i, x in enumerate(h)) for h in heavy if None not in h], np.int64)
            grow = (key == d) & np.isin(found >> (leaves.bits * (depth - d)), heads) & (numbers[d] > 0)
            # A leaf that ends with its prefix goes with the leaf itself; all its nodes are partial then.
            ends = (key == d) & np.isin(found >> (leaves.bits * (depth - d)), heads) & (numbers[d] == 0)
            key[grow | ends] = d + 1
            hashed = np.where(grow, (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[numbers[d]], hashed)
        group = ((hashed >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
        # Rows of one group and language; a row's list of words is cut from one array, so that small rows cost no more.
        langs = list(leaves.numbers)
        code = {lang: i for i, lang in enumerate(langs)}
        lang_of = np.array([0] + [code[lang] for lang, _ in leaves.words], np.int64)
        block = group * len(langs) + lang_of[numbers[0]]
        del found, hashed, group
        order = np.argsort(block, kind="stable")
        block, totals, key = block[order], totals[order].astype(np.int32), key[order]
        numbers = [n[order] for n in numbers]
        listed = pa.array([None] + [w for _, w in leaves.words], pa.binary())
        starts = np.flatnonzero(np.r_[True, np.diff(block) != 0])
        cuts = np.unique(np.r_[starts[np.searchsorted(starts, np.arange(0, len(block), ROW_LEAVES), "right") - 1], len(block)])
        for first, last in zip(cuts, cuts[1:]):
            part = slice(first, last)
            ends = np.r_[starts[(starts >= first) & (starts < last)], last] - first
            row_of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            spread = np.concatenate([(row_of << leaves.bits) | n[part] for n in numbers])
            used, places = np.unique(spread, return_inverse=True)
            firsts = np.searchsorted(used >> leaves.bits, np.arange(len(ends)))
            places = (places.reshape(depth, -1) - firsts[row_of]).T.astype(np.int32)
            blocks = block[part][ends[:-1]]
            ends = ends.astype(np.int32)
            columns = [
                pa.array(blocks // len(langs)),
                pa.array([langs[x] for x in (blocks % len(langs)).tolist()]),
                pa.ListArray.from_arrays(firsts.astype(np.int32), listed.take(pa.array(used & ((1 << leaves.bits) - 1)))),
                pa.ListArray.from_arrays(ends * depth, places.ravel()),
                pa.ListArray.from_arrays(ends, totals[part]),
                pa.ListArray.from_arrays(ends, key[part].astype(np.int32)),
            ]
            rows = pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
            yield from slices([rows])

    return emit


def _subtrees(depth: int, min_count: int):
    """The nodes of one group's subtree: runs of equal prefixes in its sorted leaves."""
    schema = arrow_schema(NODES)

    def build(table: pa.Table) -> pa.Table:
        own: dict[tuple, int] = {None: 0}
        parts, totals, keys = [], [], []
        for row in range(table.num_rows):
            cell = lambda name: table.column(name)[row].values
            lang = table.column("lang")[row].as_py()
            numbers = [own.setdefault(w if w is None else (lang, w), len(own)) for w in cell("words").to_pylist()]
            parts.append(np.array(numbers, np.int32)[cell("places").to_numpy().reshape(-1, depth).T])
            totals.append(cell("totals").to_numpy().astype(np.int64))
            keys.append(cell("keys").to_numpy())
        places, total, key = np.concatenate(parts, axis=1), np.concatenate(totals), np.concatenate(keys)
        order = np.lexsort(places[::-1])
        places, total, key = places[:, order], total[order], key[order]
        named, rows = list(own), []
        new = np.zeros(places.shape[1], bool)
        new[:1] = True
        for d in range(1, depth + 1):
            new[1:] |= places[d - 1, 1:] != places[d - 1, :-1]
            starts = np.flatnonzero(new)
            # A node is whole if its group's prefix is no longer than it: leaves below one may differ in that.
            for whole in (True, False):
                mine = (key <= d) == whole
                sums = np.add.reduceat(np.where(mine, total, 0), starts)
                there = (np.add.reduceat(mine.astype(np.int64), starts) > 0) & (places[d - 1, starts] > 0)
                if whole:
                    there &= sums >= min_count
                for words, f in zip(places[:d, starts[there]].T.tolist(), sums[there].tolist()):
                    rows.append((named[words[0]][0], [named[w][1].decode() for w in words], f, whole))
        columns = list(zip(*rows)) or [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return build


def phrase_counts(docs: DataFrame, depth: int = 3, min_count: int = 10, leaf_budget: int = LEAF_BUDGET) -> tuple[DataFrame, DataFrame]:
    """``f`` of every phrase of 1 to ``depth`` words counted ``min_count`` times or more, and ``n`` per language."""
    counts = durable(_map_leaves(docs, depth, _prefix_counts(depth), PREFIXES))
    totals = counts.where("words is null").groupBy("lang").agg(F.sum("n").alias("n"))
    positions = totals.agg(F.sum("n")).first()[0] or 0
    groups = max(1, math.ceil(positions / leaf_budget))
    # Prefixes of more positions than the budget grow; at most ``positions / budget`` of them per depth.
    heavy = counts.where("words is not null").groupBy("lang", "words").agg(F.sum("n").alias("n")).where(F.col("n") > leaf_budget)
    grown = {(r.lang, tuple(w.encode() for w in r.words)) for r in heavy.collect()}
    blocks = _map_leaves(docs, depth, _dealt(depth, groups, grown), BLOCKS)
    nodes = durable(blocks.groupBy("group").applyInArrow(_subtrees(depth, min_count), NODES))
    whole = nodes.where("whole").select("lang", "words", "f")
    summed = nodes.where(~F.col("whole")).groupBy("lang", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    f = whole.unionByName(summed).select("lang", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size"), "f")
    return durable(f), totals


def collocations(docs: DataFrame, min_count: int = 10, top: int = 2000, share_pct: int = 50, leaf_budget: int = LEAF_BUDGET) -> DataFrame:
    """Per language the first ``top`` phrases of 2 to 3 words: lang, rank, phrase, a, l, r, n, score (and k, the cut)."""
    docs = docs.select(docs["text"].alias("text"), docs["lang"].alias("lang"))
    f, totals = phrase_counts(docs, 3, min_count, leaf_budget)
    candidates = f.where(F.col("size") >= 2).select("lang", "phrase", F.split("phrase", " ").alias("w"), F.col("f").alias("a"))
    cuts = candidates.select(
        "lang", "phrase", "a",
        F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"), "w",
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, "k"), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("right"),
    )
    lookup = f.select("lang", "phrase", "f")
    left = lookup.select(F.col("lang").alias("ll"), F.col("phrase").alias("lp"), F.col("f").alias("l"))
    right = lookup.select(F.col("lang").alias("rl"), F.col("phrase").alias("rp"), F.col("f").alias("r"))
    scored = (
        cuts.join(left, (cuts["lang"] == left["ll"]) & (cuts["left"] == left["lp"]))
        .join(right, (cuts["lang"] == right["rl"]) & (cuts["right"] == right["rp"]))
        .select(
            "lang", "phrase", "a", "k", "l", "r",
            F.expr("cast(a as decimal(38,0)) * a * 1000000 div (cast(l as decimal(38,0)) * r)").alias("score"),
        )
    )
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.*")
    # A longer candidate holds its first and its last two words.
    longer = candidates.where(F.size("w") == 3).select(
        "lang", F.explode(F.array(F.array_join(F.slice("w", 1, 2), " "), F.array_join(F.slice("w", 2, 2), " "))).alias("inner"), F.col("a").alias("fl")
    )
    covering = longer.groupBy("lang", "inner").agg(F.max("fl").alias("fl"))
    kept = best.join(covering, (best["lang"] == covering["lang"]) & (best["phrase"] == covering["inner"]), "left").where(
        covering["fl"].isNull() | (covering["fl"] * 100 < best["a"] * share_pct)
    ).select(best["*"])
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"), "k"
    )
