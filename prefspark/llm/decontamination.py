"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting per (document, term): the term's positions in the document. A
phrase of test words is found by intersecting the posting lists of its terms, each shifted by
the term's place in the phrase, from the rarest term on: the rarest list proposes starts, the
second rarest thins them, and only what is left meets the frequent terms' lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, first_row_id, map_batches, sent_if_small, slices
from prefspark.storage import durable

#: Consecutive test words that make a phrase.
PHRASE = 10
#: Most distinct test terms that tasks are given as a filter; with more, all terms are indexed.
VOCABULARY_LIMIT = 1_000_000

#: The term of a document's own record, whose only "position" is its number of words.
RECORD = ""

POSTINGS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("key", T.LongType()),
        T.StructField("term", T.StringType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
    ]
)

# A-Z become a-z; digits, letters and all bytes of characters beyond ASCII stay; the rest parts words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text, as UTF-8."""
    return text.encode().translate(_WORD_BYTES).split(b" ") if text else []


def build_index(table: DataFrame, key: str, terms: list[str] | None = None, row: str | None = None) -> DataFrame:
    """Stored postings of a table's ``text``: ``row_id, key, term, positions``.

    ``row_id`` is unique to each row, so repeated rows and equal or null keys don't mix; it is the
    number in the column ``row``, if one is named. With
    ``terms``, postings of other terms are left out, as no phrase asks for them; positions still
    count all words. Each row also has a record with its number of words.
    """
    vocabulary = None if terms is None else sorted(terms)
    schema = arrow_schema(POSTINGS)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if vocabulary is None else {t.encode(): i for i, t in enumerate(vocabulary)}
        names = None if vocabulary is None else pa.array([*vocabulary, RECORD], pa.string())
        row_id = first_row_id()
        for batch in slices(batches, 256):
            rows, keys, found, spots, sizes = [], [], [], [], []
            local: dict[bytes, int] = {}
            for k, text, number in zip(*(c.to_pylist() for c in batch.columns)):
                own_row = row_id if row is None else number
                words = [w for w in words_of(text) if w]
                if known is None:
                    ids = np.array([local.setdefault(w, len(local)) for w in words], np.int64)
                else:
                    ids = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
                where = np.flatnonzero(ids >= 0)
                where = where[np.argsort(ids[where], kind="stable")]
                own = ids[where]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
                found += [own[first], [-1]]
                spots += [where, [len(words)]]
                sizes += [np.diff(np.r_[first, len(own)]), [1]]
                rows += [own_row] * (len(first) + 1)
                keys += [k] * (len(first) + 1)
                row_id += 1
            if names is None:
                table = pa.array([*(w.decode() for w in local), RECORD], pa.string())
            else:
                table = names
            codes = np.concatenate(found).astype(np.int64)
            codes[codes < 0] = len(table) - 1
            offsets = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
            positions = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(spots).astype(np.int32)))
            yield pa.record_batch(
                [pa.array(rows, pa.int64()), pa.array(keys, pa.int64()), table.take(pa.array(codes)), positions], schema=schema
            )

    number = F.lit(None).cast("long") if row is None else table[row]
    rows = table.select(table[key].cast("long").alias("key"), table["text"], number.alias("number"))
    return durable(map_batches(rows, post, POSTINGS), compression="zstd")


def phrases_of(items: DataFrame, length: int = PHRASE) -> DataFrame:
    """Each phrase of an index of test items: ``key, phrase, terms``.

    A phrase is ``length`` consecutive words; a shorter item, unless empty, is one phrase.
    """
    sizes = items.where(F.col("term") == RECORD).select("row_id", F.col("positions")[0].alias("n"))
    words = items.where(F.col("term") != RECORD).select("row_id", "key", "term", F.explode("positions").alias("pos"))
    last = F.greatest(F.col("n") - length, F.lit(0))
    inside = words.join(sizes, "row_id").select(
        "row_id",
        "key",
        "term",
        "pos",
        F.explode(F.sequence(F.greatest(F.col("pos") - length + 1, F.lit(0)), F.least(F.col("pos"), last))).alias("at"),
    )
    phrases = inside.groupBy("row_id", "key", "at").agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("words"))
    terms = F.col("words.term")
    return phrases.select("key", F.array_join(terms, " ").alias("phrase"), terms.alias("terms")).distinct()


def _near(positions: Column, expected: Column, slop: int) -> Column:
    if not slop:
        return F.array_contains(positions, expected)
    return F.exists(positions, lambda p: F.abs(p - expected) <= slop)


def phrase_matches(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Occurrences ``row_id, phrase, n, start`` of distinct phrases in an index.

    ``slop`` 0 asks for the exact phrase. A larger one asks for proximity: every word within
    ``slop`` places of where the phrase's rarest word calls for it, ``start`` then being where
    the phrase would begin. Joins are on (row, term) or on the term alone; only a rarest
    term's list is joined to phrases, so a frequent term costs nothing until few starts are left.
    """
    postings = index.where(F.col("term") != RECORD).select("row_id", "term", "positions")
    frequency = postings.groupBy("term").agg(F.sum(F.size("positions")).alias("frequency"))
    distinct = phrases.select("phrase", "terms").distinct()
    words = distinct.select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("off", "term"))
    # A phrase with a term that no text holds can't occur: it loses a row here and is dropped.
    plans = (
        words.join(frequency, "term")
        .groupBy("phrase", "n")
        .agg(F.array_sort(F.collect_list(F.struct("frequency", "off", "term"))).alias("plan"))
        .where(F.size("plan") == F.col("n"))
    )
    plans = durable(plans)

    def terms_of(ranks: DataFrame) -> DataFrame:
        return sent_if_small(durable(ranks.select("term").distinct()), 64)

    rarest = plans.select("phrase", "n", F.col("plan")[0]["term"].alias("term"), F.col("plan")[0]["off"].alias("off"))
    lists = postings.join(terms_of(rarest), "term", "left_semi")
    starts = (
        lists.join(rarest, "term")
        .select("row_id", "phrase", "n", F.explode("positions").alias("pos"), "off")
        .select("row_id", "phrase", "n", (F.col("pos") - F.col("off")).alias("start"))
        .where((F.col("start") >= 0) | F.lit(slop > 0))
    )
    starts = durable(starts)
    single = starts.where(F.col("n") == 1)

    def intersect(candidates: DataFrame, ranks: DataFrame) -> DataFrame:
        """Candidates whose given terms all stand where the phrase has them."""
        asked = candidates.join(ranks, "phrase")
        rows = sent_if_small(durable(candidates.select("row_id").distinct()), 16)
        held = postings.join(terms_of(ranks), "term", "left_semi").join(rows, "row_id", "left_semi")
        met = asked.join(held, ["row_id", "term"]).where(_near(F.col("positions"), F.col("start") + F.col("off"), slop))
        counted = met.groupBy("row_id", "phrase", "n", "start", "asked").agg(F.count(F.lit(1)).alias("met"))
        return counted.where(F.col("met") == F.col("asked")).select("row_id", "phrase", "n", "start")

    def ranked(first: int, count: int) -> DataFrame:
        part = F.slice("plan", first, count)
        return plans.select("phrase", F.size(part).alias("asked"), F.explode(part).alias("w")).select(
            "phrase", "asked", "w.term", "w.off"
        )

    second = durable(intersect(starts.where(F.col("n") > 1), ranked(2, 1)))
    pairs = second.where(F.col("n") == 2)
    rest = intersect(second.where(F.col("n") > 2), ranked(3, 1 << 30))
    return single.unionByName(pairs).unionByName(rest)


def contamination(docs: DataFrame, items: DataFrame, length: int = PHRASE, slop: int = 0, row: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the words inside an occurrence of a test phrase, ``n_items`` the test items
    with an occurring phrase. A null or empty text has no words and no hits; an empty item, or
    one without words, has no phrase; an item without an id hits but isn't listed. Repeated
    documents have a row each; items that share an id count once; an empty table of items
    finds nothing. If ``row`` names a column of unique row numbers, the result has it too. Other
    columns are not read.
    """
    test = build_index(items, "item_id")
    vocabulary = test.where(F.col("term") != RECORD).select("term").distinct()
    known = [r.term for r in vocabulary.limit(VOCABULARY_LIMIT + 1).collect()]
    index = build_index(docs, "doc_id", known if len(known) <= VOCABULARY_LIMIT else None, row)
    phrases = durable(phrases_of(test, length))
    matches = durable(phrase_matches(index, phrases, slop))
    hit = (
        matches.select("row_id", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos"))
        .distinct()
        .groupBy("row_id")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    listed = phrases.where(F.col("key").isNotNull()).select("phrase", F.col("key").cast("string").alias("item"))
    found = (
        matches.select("row_id", "phrase").distinct().join(listed, "phrase").select("row_id", "item").distinct()
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    records = index.where(F.col("term") == RECORD).select(
        "row_id", F.col("key").alias("doc_id"), F.col("positions")[0].cast("long").alias("n_words")
    )
    joined = records.join(hit.join(found, "row_id", "left"), "row_id", "left")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        *([] if row is None else [F.col("row_id").alias(row)]),
    )
