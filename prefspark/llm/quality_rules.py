"""Document rules and cross-document line frequency, in built-in functions only.

A line that many distinct documents of one host share is boilerplate. Lines are normalised
and hashed, distinct documents are counted per host and line, and lines above the limit are
taken away from every document but the first that has them. A document left with too small a
share of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import let
from prefspark.storage import durable

#: Distinct documents of a host that may share a line.
LINE_LIMIT = 20
#: Per cent of a document's words that must be left.
LEAST_LEFT = 20

# Fixed values of the base rules.
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW_WORDS = 8

_SPACE = r"[ \t-\r]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def _has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(r"[^ \t-\r]"))


def _lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), _has_word)


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _combined(values: Column, by: int) -> Column:
    """A hash of each value and the one ``by`` places on."""
    return let(
        values,
        lambda v: F.zip_with(
            F.slice(v, 1, F.greatest(F.size(v) - by, F.lit(0))), _shifted(v, by), lambda a, b: F.xxhash64(a, b)
        ),
    )


def _window_hashes(words: Column) -> Column:
    """A hash of every window of eight words: of two words, of two such pairs, of two such fours."""
    single = F.transform(words, lambda w: F.xxhash64(w))
    return _combined(_combined(_combined(single, 1), 2), 4)


def _covered(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""

    def repeated(placed: Column) -> Column:
        same = lambda x, i: placed[i]["h"] == x["h"]
        last = F.size(placed) - 1
        return F.filter(
            placed,
            lambda x, i: ((i > 0) & same(x, F.greatest(i - 1, F.lit(0)))) | ((i < last) & same(x, F.least(i + 1, last))),
        )

    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = F.array_sort(F.transform(let(placed, repeated), lambda x: x["i"]))
    empty = F.struct(F.lit(0).alias("words"), F.lit(-WINDOW_WORDS).alias("last"))
    total = F.aggregate(
        starts,
        empty,
        lambda acc, at: F.struct(
            (acc["words"] + F.least(at - acc["last"], F.lit(WINDOW_WORDS))).alias("words"), at.alias("last")
        ),
        lambda acc: acc["words"],
    )
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(F.lit(0))


def base_columns(text: Column) -> list[Column]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` of a text."""
    text = F.coalesce(text, F.lit(""))
    words = let(
        _words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            let(_window_hashes(w), _covered).cast("long").alias("n_repeat_words"),
        ),
    )
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    repeated = let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return [words.alias("_w"), symbols.cast("long").alias("n_symbols"), repeated.cast("long").alias("n_dup_lines")]


def normalised(line: Column) -> Column:
    """Lower case, digits as one sign, white space as one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), _SPACE, " "))


def _without_lines(text: Column, places: Column) -> Column:
    """The text without the lines at ``places``, counted from 0."""
    return let(
        F.split(text, "\n"),
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), places), lambda i: x[i]), "\n"
        ),
    )


def _ruled(docs: DataFrame, line_limit: int, least_left: int, host: str, carried: list[str]) -> DataFrame:
    """``carried`` columns of all rows, ``text`` without the frequent lines, and the struct ``_rules``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        docs["doc_id"].cast("long").alias("doc_id"),
        docs[host].cast("string").alias("host"),
        docs["text"].alias("text"),
        F.struct(F.lit(0).alias("_"), *(docs[c] for c in carried)).alias("carried"),
    )
    measured = durable(
        rows.select(
            "row_id",
            "doc_id",
            "host",
            F.xxhash64("text", F.length("text")).alias("text_hash"),
            F.filter(
                F.transform(
                    F.split(F.coalesce("text", F.lit("")), "\n"),
                    lambda x, i: F.struct(
                        i.alias("place"),
                        F.when(_has_word(x), F.xxhash64(normalised(x))).alias("line"),
                        F.size(_words(x)).alias("words"),
                    ),
                ),
                lambda x: x["line"].isNotNull(),
            ).alias("lines"),
            *base_columns(F.col("text")),
            "carried",
        ).select("row_id", "doc_id", "host", "text_hash", "lines", "_w.*", "n_symbols", "n_dup_lines", "carried")
    )
    lines = measured.select("row_id", "doc_id", "host", "text_hash", F.inline("lines"))
    last_id = F.lit(2**63 - 1)
    once = lines.groupBy("host", "line", "text_hash").agg(F.min(F.coalesce("doc_id", last_id)).alias("first"))
    frequent = once.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents"), F.min("first").alias("first")).where(
        F.col("documents") > line_limit
    ).select(F.col("host").alias("_host"), F.col("line").alias("_line"), "first")
    taken = (
        lines.join(frequent, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")))
        .where(F.coalesce("doc_id", last_id) != F.col("first"))
        .groupBy("row_id")
        .agg(F.sum("words").alias("taken"), F.collect_list("place").alias("places"))
    )
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    left = n_words - F.coalesce("taken", F.lit(0))
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
    rules = F.struct(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        left.cast("long").alias("n_left_words"),
        failed.alias("base_failed"),
        (~failed & (100 * left >= least_left * n_words)).alias("kept"),
    )
    columns = [F.col("carried")[c].alias(c) for c in carried]
    if "text" in carried:
        text = F.col("carried")["text"]
        whole = F.col("places").isNull()
        columns[carried.index("text")] = F.when(whole, text).otherwise(_without_lines(text, F.col("places"))).alias("text")
    return measured.join(taken, "row_id", "left").select(*columns, rules.alias("_rules"))


def cleaned_documents(
    docs: DataFrame, line_limit: int = LINE_LIMIT, least_left: int = LEAST_LEFT, host: str = "source"
) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without the frequent lines, and a struct ``_rules``.

    ``_rules`` has the columns of :func:`quality_rules`, which says which lines go; the base counts
    are those of the text as it came. Lines that stay, empty ones among them, are unchanged and in
    order. A null text stays null.
    """
    return _ruled(docs, line_limit, least_left, host, docs.columns)


def quality_rules(docs: DataFrame, line_limit: int = LINE_LIMIT, least_left: int = LEAST_LEFT, host: str = "source") -> DataFrame:
    """One row per document with the base counts, ``n_left_words``, ``base_failed`` and ``kept``.

    A host is a value of the ``host`` column; null is a host of its own. Exact copies of a
    text count as one document of a host, so a copied document isn't taken for boilerplate.
    The first document of a frequent line, by ``doc_id``, keeps it: of a page that a host
    repeats with small changes, one stays. A null text is empty and fails the base rules.
    Repeated rows have a row each with equal results. Null ids come last when the first
    document of a line is sought. Other columns are not read. :func:`cleaned_documents` gives
    the texts without the lines that are taken away.
    """
    return _ruled(docs, line_limit, least_left, host, []).select("_rules.*")
