"""Train/test deduplication: normalised exact copies, and near copies by a set-similarity join.

Near copies are found with prefix filtering: every distinct text becomes the set of its
word shingles, as 64-bit hashes. In any fixed order of the hashes, two sets with Jaccard
similarity ``t`` or more share one among the first ``n - ceil(t n) + 1`` of each. The order puts
frequent shingles last, as counted in a bounded, hash-chosen share of the texts, then goes by
hash: the share decides how many candidates there are, never which pairs are found. Prefixes are
cut inside their row, so only they are shuffled, a fifth of all shingles, and joined train
against test (bipartite). How many hashes two prefixes share bounds the overlap of their sets,
as what lies behind a prefix can't add more than its number: most pairs end there.

Every candidate pair is confirmed on the full sets of its two texts, but no text moves once per
pair: a train text goes to one home, named after its least candidate, so that a group of near
copies meets at one place, and a test text goes once to each home of its candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.storage import durable


def normalised(text: Column) -> Column:
    """Lower case, blanks collapsed to one space, no blanks at the ends; null is empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def words_of(norm: Column) -> Column:
    return F.filter(F.split(norm, " "), lambda w: w != "")


#: Texts whose shingles are counted for the order of the prefixes, and how many of these a task holds.
ORDER_TEXTS = 20_000
ORDER_SHINGLES = 50_000
ORDER_LEAST = 8
#: Rows up to which each task holds an integer of every row (32 MB); above, rows are joined to them.
HELD_ROWS = 8_000_000
#: Texts of a home, about: train texts, and test texts of one of its parts. A text counts once per so many shingles.
HOME_TRAIN = 256
HOME_TEST = 1024
HOME_SHINGLES = 2048
#: Places among which the hashes of one least row are dealt.
LANES = 4
#: Bits of a prefix token below the count of its shingle.
_HASH_BITS = 51
_MOST_COUNTED = 4095


def shingle_hashes(norm: Column, size: int) -> Column:
    """Distinct ``size``-word shingles as hashes of the hashes of their words; with fewer words all of them as one; none: none.

    The words' hashes are bound once, as a lambda variable: an expression read at every position
    would be computed again there.
    """

    def of(h: Column) -> Column:
        n = F.size(h)
        grams = F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(grams))

    return F.transform(F.array(F.transform(words_of(norm), lambda w: F.xxhash64(w))), of)[0]


def _place(row: Column) -> tuple[Column, Column]:
    """The task that numbered a row by ``monotonically_increasing_id``, and the row's place there."""
    return F.shiftright(row, 33).cast("int"), row.bitwiseAND((1 << 33) - 1).cast("int")


def _with_value(rows: DataFrame, values: DataFrame) -> DataFrame:
    """The ``rows`` that ``values`` (row, value) names, with their integer; no shuffle of rows if each task can hold all integers.

    ``rows`` must be all rows that one plan has numbered, so that places in a task have no gaps.
    """
    count, last = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("row"), F.lit(0))).first()
    if count > HELD_ROWS:
        return rows.join(values, "row")
    named = rows.select("row").join(values, "row", "left")
    of_task = named.groupBy(_place(F.col("row"))[0].alias("task")).agg(F.sort_array(F.collect_list(F.struct("row", "value"))).alias("rows"))
    of_task = of_task.select("task", F.transform("rows", lambda r: r["value"]).alias("values"))
    tasks = rows.sparkSession.range((last >> 33) + 1).select(F.col("id").cast("int").alias("task")).join(of_task, "task", "left")
    held = tasks.agg(F.sort_array(F.collect_list(F.struct("task", "values"))).alias("all")).select(F.transform("all", lambda t: t["values"])).scalar()
    task, place = _place(F.col("row"))
    return rows.withColumn("value", F.get(F.get(held, task), place)).where(F.col("value").isNotNull())


def _counted(rows: DataFrame, count: int, size: int) -> tuple[Column, int]:
    """Counts of the shingles that many texts of a bounded share hold, as an array by slot; shingles of one slot share a count.

    ``rows`` has one row for each of ``count`` texts.
    """
    step = max(1, count // ORDER_TEXTS)
    share = rows.where(F.pmod(F.xxhash64("row"), F.lit(step)) == 0)
    counted = share.select(F.explode(shingle_hashes(F.col("norm"), size)).alias("token"))
    counted = counted.groupBy("token").agg(F.count(F.lit(1)).cast("int").alias("n")).where(F.col("n") >= ORDER_LEAST)
    held = durable(counted.orderBy(F.desc("n"), "token").limit(ORDER_SHINGLES))
    slots = max(1, 4 * held.count())
    filled = held.groupBy(F.pmod("token", F.lit(slots)).alias("id")).agg(F.least(F.max("n"), F.lit(_MOST_COUNTED)).alias("n"))
    every = rows.sparkSession.range(slots).join(filled, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct("id", "n")))
    return every.agg(ordered.alias("all")).select(F.transform("all", lambda x: x["n"].cast("long"))).scalar(), slots


def _confirmed(rows: DataFrame, candidates: DataFrame, size: int, similarity_pct: int) -> DataFrame:
    """The candidates (train_row, test_row, with their numbers of shingles na, nb) whose full sets are similar."""
    most = lambda n, texts: F.ceil(F.sum(F.greatest(F.lit(1.0), F.col(n) / HOME_SHINGLES)) / texts).cast("int")
    homes = candidates.groupBy("train_row").agg(F.min("test_row").alias("leader"), F.min("na").alias("na"))
    groups = homes.groupBy("leader").agg(most("na", HOME_TRAIN).alias("blocks"))
    # Homes that happen to get one name are one home.
    home = F.hash("leader", F.pmod(F.xxhash64("train_row"), "blocks")).alias("home")
    homes = durable(homes.join(groups, "leader").select("train_row", home))
    visits = candidates.join(homes, "train_row").groupBy("test_row", "home").agg(F.collect_list("train_row").alias("partners"), F.min("nb").alias("nb"))
    visits = durable(visits)
    # Homes that very many test texts visit have parts: each train text is in all of them, each visit in one.
    busy = durable(visits.groupBy("home").agg(most("nb", HOME_TEST).alias("parts")).where("parts > 1"))
    parted = lambda df: df.join(F.broadcast(busy), "home", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    values = homes.select(F.col("train_row").alias("row"), F.col("home").alias("value"))
    named = _with_value(rows, values.unionByName(visits.select(F.col("test_row").alias("row"), F.lit(0).alias("value")).distinct()))
    train = parted(named.where("train").select(F.col("row").alias("train_row"), "norm", F.col("value").alias("home")))
    train = train.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    test = parted(named.where(~F.col("train")).select(F.col("row").alias("test_row"), "norm").join(visits, "test_row"))
    test = test.withColumn("part", F.pmod(F.xxhash64("test_row"), "parts").cast("int"))
    # Texts are smaller than their hashes: sets are made behind the shuffle.
    train = train.select("home", "part", "train_row", "norm").repartition("home", "part").withColumn("a", shingle_hashes(F.col("norm"), size)).drop("norm")
    test = test.select("home", "part", "test_row", "partners", "norm").repartition("home", "part").withColumn("b", shingle_hashes(F.col("norm"), size)).drop("norm")
    inter = F.size(F.array_intersect("a", "b")).cast("long")
    met = train.join(test, ["home", "part"]).where(F.array_contains("partners", F.col("train_row")))
    # |a & b| >= t |a | b|
    return met.where(inter * (100 + similarity_pct) >= (F.size("a").cast("long") + F.size("b")) * similarity_pct).select("train_row", "test_row")


def prompt_dedup(train: DataFrame, test: DataFrame, size: int = 5, similarity_pct: int = 80) -> DataFrame:
    """Per test row: doc_id, n_exact, n_near, first_train_id, contaminated.

    ``train`` and ``test`` need ``doc_id`` and ``text``. ``n_exact``: train rows with the same
    normalised text (empty texts count too); ``n_near``: train rows whose shingle set has
    ``100 * |A & B| >= similarity_pct * |A | B|`` with the test row's (exact copies with words
    included; empty sets link with nothing); ``first_train_id``: the least train ``doc_id``
    among both, null without any. Repeated rows count as often as they occur; a null
    ``doc_id`` is carried as it is; other columns are ignored.
    """
    def side(df: DataFrame, is_train: bool) -> DataFrame:
        return df.select(F.lit(is_train).alias("train"), df["doc_id"].alias("doc_id"), normalised(df["text"]).alias("norm"))

    # Every row is stored once, with a number; texts are told apart by their key.
    both = side(train, True).unionByName(side(test, False)).withColumn("row", F.monotonically_increasing_id())
    rows = durable(both.withColumn("key", F.sha2("norm", 256)), "zstd")
    # Distinct texts of each side, with how many rows hold them and the least id; the least row stands for them.
    texts = durable(rows.groupBy("train", "key").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id"), F.min("row").alias("row")))
    first = _with_value(rows, texts.select("row", F.lit(1).alias("value"))).drop("value")
    counts, slots = _counted(first, texts.count(), size)
    hashed = first.select("row", "train", shingle_hashes(F.col("norm"), size).alias("h")).where(F.size("h") > 0).withColumn("_counts", counts)
    # The count above the hash: sorted, they are in the order of the prefixes. One per shingle, so that a collision loses nothing.
    low = F.lit((1 << _HASH_BITS) - 1)
    ordered = F.sort_array(F.transform("h", lambda h: F.shiftleft(F.get(F.col("_counts"), F.pmod(h, F.lit(slots)).cast("int")), _HASH_BITS).bitwiseOR(h.bitwiseAND(low))))
    least = lambda n: f"({similarity_pct} * cast({n} as bigint) + 99) div 100"  # noqa: E731  ceil(t n), in integers
    need = F.expr(f"size(h) - {least('size(h)')} + 1").cast("int")
    tokens = hashed.select("row", "train", F.size("h").alias("n"), F.explode(F.slice(ordered, F.lit(1), need)).alias("token"))
    # Hashes that both sides hold go to where the least row that holds them goes: those that two near copies
    # share mostly meet there, and a pair leaves as few rows, not as one for each.
    held = Window.partitionBy("token")
    tokens = tokens.withColumn("least_row", F.min("row").over(held)).withColumn("both", F.min("train").over(held) != F.max("train").over(held)).where("both")
    lists = tokens.withColumn("lane", F.pmod("token", F.lit(LANES))).repartition("least_row", "lane").groupBy("least_row", "lane", "token").agg(
        *[F.collect_list(F.when(F.col("train") == side, F.struct("row", "n"))).alias(name) for name, side in (("a", True), ("b", False))]
    )
    met = lists.select(F.explode("a").alias("a"), "b").select("a", F.explode("b").alias("b"))
    met = met.select(F.col("a.row").alias("train_row"), F.col("b.row").alias("test_row"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
    # Sizes of similar sets differ by at most the share: 100 * min >= pct * max.
    met = met.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * similarity_pct)
    met = met.groupBy("train_row", "test_row").agg(F.count(F.lit(1)).alias("shared"), F.min("na").alias("na"), F.min("nb").alias("nb"))
    # The prefix that ends first has all common hashes up to its end in the other one too; behind it are n - need of its own.
    overlap = f"({similarity_pct} * (cast(na as bigint) + nb) + {99 + similarity_pct}) div {100 + similarity_pct}"
    candidates = durable(met.where(f"shared >= {overlap} - {least('greatest(na, nb)')} + 1").select("train_row", "test_row", "na", "nb"))
    confirmed = _confirmed(rows, candidates, size, similarity_pct)
    train_texts = texts.where("train")
    test_keys = texts.where(~F.col("train")).select(F.col("row").alias("test_row"), F.col("key").alias("test_key"))
    te = rows.where(~F.col("train"))
    near = confirmed.join(train_texts.select(F.col("row").alias("train_row"), "copies", "least_id"), "train_row").join(test_keys, "test_row").groupBy("test_key").agg(
        F.sum("copies").alias("n_near"), F.min("least_id").alias("near_id")
    )
    exact = train_texts.select(F.col("key").alias("test_key"), F.col("copies").alias("n_exact"), F.col("least_id").alias("exact_id"))
    found = te.select("doc_id", F.col("key").alias("test_key")).join(exact, "test_key", "left").join(near, "test_key", "left")
    return found.select(
        "doc_id",
        F.coalesce("n_exact", F.lit(0)).cast("long").alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.least("exact_id", "near_id").alias("first_train_id"),
        ((F.coalesce("n_exact", F.lit(0)) + F.coalesce("n_near", F.lit(0))) > 0).alias("contaminated"),
    )
