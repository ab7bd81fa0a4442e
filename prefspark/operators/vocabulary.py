"""A corpus dictionary, and coding texts with it.

The dictionary holds all words, or the ``size`` most frequent ones. Its bytes are
measured; up to ``BROADCAST_BYTES`` each task gets all of it and no token is shuffled.
Above that, each task gets its head, the most frequent words that fit; only the occurrences
of other words, which are rare ones, are joined to the rest by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.text import strip_text
from prefspark.functions.tokens import split_tokens
from prefspark.operators.ordinals import dense_ordinal
from prefspark.storage import durable

BROADCAST_BYTES = 32 * 1024 * 1024
_ENTRY_BYTES = 64
_RANKING_SLICES = 256


def build_vocabulary(df: DataFrame, text: str, size: int | None = None) -> DataFrame:
    """Ids for the special tokens and for all words of a corpus, or its ``size`` most frequent.

    Words are counted before the shuffle. The best ``size`` are taken in every slice of
    the distinct words and then among those, so that no task sees all distinct words. The
    result is stored: it is small and every coding step reads it.
    """
    if size is not None and size < 1:
        raise ValueError("size must be at least 1")
    best = [F.desc("n"), F.col("token")]
    counts = (
        df.select(F.explode(split_tokens(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(~F.col("token").isin(*D.SPECIAL_TOKENS))
    )
    specials = (
        df.sparkSession.range(1)
        .select(F.posexplode(F.lit(list(D.SPECIAL_TOKENS))).alias("id", "token"))
        .select("token", "id", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("special"))
    )
    if size is None:
        numbered = dense_ordinal(durable(counts.withColumn("_rarity", -F.col("n"))), ["_rarity", "token"])
        ids = (F.col("ordinal") + (len(D.SPECIAL_TOKENS) - 1)).cast("int")
        return durable(specials.unionByName(numbered.select("token", ids.alias("id"), "n", F.lit(False).alias("special"))))
    in_slice = Window.partitionBy(F.pmod(F.hash("token"), F.lit(_RANKING_SLICES))).orderBy(*best)
    ranked = (
        counts.withColumn("_place", F.row_number().over(in_slice))
        .where(F.col("_place") <= size)
        .orderBy(*best)
        .limit(size)
    )
    # The window has no partitions, over at most ``size`` rows.
    words = ranked.select(
        "token",
        (F.row_number().over(Window.orderBy(*best)) + (len(D.SPECIAL_TOKENS) - 1)).alias("id"),
        "n",
        F.lit(False).alias("special"),
    )
    return durable(specials.unionByName(words))


def _entries_and_bytes(vocabulary: DataFrame) -> tuple[int, int]:
    row = vocabulary.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("token") + _ENTRY_BYTES), F.lit(0))
    ).first()
    return row[0], row[1]


def _slots(entries: int) -> int:
    return max(1, entries)


def token_maps(vocabulary: DataFrame, slots: int) -> Column:
    """The dictionary as one value: an array of small maps addressed by token hash.

    Spark looks a key up in a map by walking its entries, so one large map would cost its
    whole length per token.
    """
    filled = vocabulary.groupBy(F.pmod(F.hash("token"), F.lit(slots)).alias("slot")).agg(
        F.map_from_entries(F.collect_list(F.struct("token", "id"))).alias("ids")
    )
    pairs = vocabulary.sparkSession.range(slots).withColumnRenamed("id", "slot").join(
        filled, "slot", "left"
    )
    ordered = F.array_sort(F.collect_list(F.struct("slot", F.map_entries("ids").alias("entries"))))
    return (
        pairs.agg(ordered.alias("maps"))
        .select(F.transform("maps", lambda m: F.map_from_entries(m.getField("entries"))))
        .scalar()
    )


def encode_tokens(
    df: DataFrame,
    columns: dict[str, str],
    vocabulary: DataFrame,
    key: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``ARRAY<INT>`` columns with the ids of text columns, ``{text: ids}``.

    Words outside the dictionary get the id of ``[UNK]``. ``key`` identifies a row.
    """
    entries, size = _entries_and_bytes(vocabulary)
    if size > broadcast_bytes:
        head = _head(entries, size, broadcast_bytes)
        return _encode_by_join(df, columns, vocabulary, head)
    return _look_up(df, columns, vocabulary, entries, F.lit(D.UNK_ID))


def _head(entries: int, size: int, broadcast_bytes: int) -> int:
    """Ids below this number are few enough for every task; words are numbered by frequency."""
    return min(entries, entries * broadcast_bytes // max(size, 1))


def _look_up(
    df: DataFrame, columns: dict[str, str], vocabulary: DataFrame, entries: int, missing: Column
) -> DataFrame:
    """Ids by a dictionary that every task holds."""
    slots = _slots(entries)
    maps = F.col("_maps")

    def lookup(token: Column) -> Column:
        return F.coalesce(F.get(maps, F.pmod(F.hash(token), F.lit(slots)))[token], missing)

    # Read once per step, the maps stay out of the rows; named twice they would be copied into each.
    for text, ids in columns.items():
        coded = df.withColumn("_maps", token_maps(vocabulary, slots))
        df = coded.withColumn(ids, F.transform(split_tokens(F.col(text)), lookup)).drop("_maps")
    return df


_SHIFT = 1 << 32
_ZERO = 1 << 31


def _packed(position: Column, number: Column) -> Column:
    """Position and id as one long that sorts by position."""
    return position.cast("long") * F.lit(_SHIFT) + number.cast("long") + F.lit(_ZERO)


def _unpacked(value: Column) -> Column:
    return (F.pmod(value, F.lit(_SHIFT)) - F.lit(_ZERO)).cast("int")


def _encode_by_join(
    df: DataFrame, columns: dict[str, str], vocabulary: DataFrame, head: int
) -> DataFrame:
    """Same result; words outside the head are joined to the rest of the dictionary.

    Rows are stored with a number of their own: a caller's key may be null or shared by rows.
    """
    nothing = F.lit(None).cast("int")
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    df = durable(_look_up(numbered, columns, vocabulary.where(F.col("id") < head), head, nothing))

    def rare(column: int, text: str, ids: str) -> Column:
        left = F.zip_with(split_tokens(F.col(text)), F.col(ids), lambda t, i: F.when(i.isNull(), t))
        placed = F.transform(
            left,
            lambda t, at: F.struct(F.lit(column).alias("_column"), at.alias("_pos"), t.alias("_token")),
        )
        empty = F.filter(placed, lambda p: p["_token"].isNotNull())
        return F.coalesce(empty, F.array().cast("array<struct<_column:int,_pos:int,_token:string>>"))

    tokens = df.select(
        "_row", F.inline(F.concat(*[rare(c, *names) for c, names in enumerate(columns.items())]))
    )
    rest = vocabulary.where(F.col("id") >= head).select(
        F.col("token").alias("_token"), F.col("id").alias("_id")
    )
    place = _packed(F.col("_pos"), F.coalesce("_id", F.lit(D.UNK_ID)))
    found = (
        tokens.join(rest.hint("shuffle_merge"), "_token", "left")
        .groupBy("_row")
        .agg(*[F.collect_list(F.when(F.col("_column") == c, place)).alias(f"_found{c}") for c in range(len(columns))])
    )

    def whole(column: int, ids: str) -> Column:
        known = F.filter(F.transform(F.col(ids), lambda i, at: _packed(at, i)), lambda p: p.isNotNull())
        more = F.coalesce(F.col(f"_found{column}"), F.array().cast("array<bigint>"))
        return F.transform(F.sort_array(F.concat(known, more)), _unpacked)

    return (
        df.join(found, "_row", "left")
        .withColumns({ids: whole(c, ids) for c, ids in enumerate(columns.values())})
        .drop("_row", *[f"_found{c}" for c in range(len(columns))])
    )


def decode_tokens(
    df: DataFrame,
    ids: str,
    text: str,
    vocabulary: DataFrame,
    key: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the text of an id array, without special tokens, stripped; ``''`` if none is left."""
    entries, size = _entries_and_bytes(vocabulary)
    places = (vocabulary.agg(F.max("id")).first()[0] or 0) + 1
    if size > broadcast_bytes or places > 2 * entries:
        return _decode_by_join(df, ids, text, vocabulary, _head(entries, size, broadcast_bytes))
    joined = F.array_join(F.transform(F.col(ids), lambda i: F.get(F.col("_words"), i)), " ")
    return df.withColumn("_words", _words_by_id(vocabulary, places)).withColumn(text, strip_text(joined)).drop("_words")


def _words_by_id(vocabulary: DataFrame, places: int) -> Column:
    """The words of the ids below ``places`` as one array.

    Position in the array is the id; special tokens and ids that nothing has are null there.
    """
    named = vocabulary.select("id", F.when(~F.col("special"), F.col("token")).alias("token"))
    all_ids = vocabulary.sparkSession.range(places).select(F.col("id").cast("int").alias("id"))
    ordered = F.array_sort(F.collect_list(F.struct("id", "token")))
    return (
        all_ids.join(named, "id", "left").agg(ordered.alias("w"))
        .select(F.transform("w", lambda w: w.getField("token")))
        .scalar()
    )


def _decode_by_join(
    df: DataFrame, ids: str, text: str, vocabulary: DataFrame, head: int
) -> DataFrame:
    """Same result; ids outside the head are joined to the rest of the dictionary."""
    df = durable(df.withColumn("_row", F.monotonically_increasing_id()))
    placed = F.transform(F.col(ids), lambda i, at: F.struct(at.alias("_pos"), i.alias("_id")))
    rare = F.filter(placed, lambda p: (p["_id"] >= head) | (p["_id"] < 0))
    rest = vocabulary.where(~F.col("special") & ((F.col("id") >= head) | (F.col("id") < 0))).select(
        F.col("id").alias("_id"), F.col("token").alias("_token")
    )
    found = (
        df.select("_row", F.inline(rare))
        .join(rest.hint("shuffle_merge"), "_id")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("_pos", "_token")).alias("_found"))
    )
    words = F.col("_words")
    known = F.transform(
        F.col(ids), lambda i, at: F.struct(at.alias("_pos"), F.get(words, i).alias("_token"))
    )
    known = F.filter(known, lambda w: w["_token"].isNotNull())
    more = F.coalesce("_found", F.array().cast("array<struct<_pos:int,_token:string>>"))
    ordered = F.transform(F.sort_array(F.concat(known, more)), lambda w: w["_token"])
    return (
        df.join(found, "_row", "left")
        .withColumn("_words", _words_by_id(vocabulary.where(F.col("id") < head), head))
        .withColumn(text, strip_text(F.array_join(ordered, " ")))
        .drop("_row", "_words", "_found")
    )
