"""Analyses the reference's documents ask for next: bootstrap interval of the win rate,
agreement of raters, and the like. All are plain aggregations over keyed tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of an md5 read as a uniform number: 52 bits, exact in a double.
UNIFORM_DIGITS = 13


def poisson_one_cdf() -> list[float]:
    """P(W <= k) of a Poisson(1) variable for k = 0, 1, ... until it rounds to 1."""
    out, term, total = [], math.exp(-1.0), 0.0
    k = 0
    while True:
        total += term
        if total >= 1.0:
            return out
        out.append(total)
        k += 1
        term /= k


def uniform(key: Column) -> Column:
    """A number in [0, 1) that only the key decides: its md5 digits, so SQL can repeat it."""
    digits = F.conv(F.substring(F.md5(key), 1, UNIFORM_DIGITS), 16, 10).cast("double")
    return digits / float(16**UNIFORM_DIGITS)


def poisson_weight(key: Column) -> Column:
    """Poisson(1) draw by the inverse of its distribution function, from :func:`uniform`."""
    u = uniform(key)
    return sum((F.when(u >= c, 1).otherwise(0) for c in poisson_one_cdf()), F.lit(0))


def winrate_bootstrap(judgements: DataFrame, replicates: int = 1000, level: float = 0.95, seed: int = 7) -> DataFrame:
    """Percentile interval of the second policy's win rate, by the Poisson bootstrap over prompts.

    Each prompt of replicate ``r`` weighs Poisson(1), drawn from the md5 of
    ``"<seed>:<prompt_id>:<r>"``: no row moves and no random state is kept, so any
    partitioning gives the same interval. Rows sharing a ``prompt_id`` are drawn together (a
    null id is one prompt, keyed ``""``); rows without a valid verdict weigh nothing. Per
    replicate one pass of sums gives wins and verdicts; a replicate without verdicts has no
    rate and is counted in ``empty_replicates``. Interval ends are percentiles with linear
    interpolation. With no verdict at all, counts are 0 and rate and ends are null.
    """
    valid = judgements.where(F.col("verdict").isin("A", "B")).select(
        F.coalesce(F.col("prompt_id").cast("string"), F.lit("")).alias("key"),
        (F.col("verdict") == "B").cast("int").alias("win"),
    )
    per_prompt = valid.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("win").alias("wins"))
    drawn = per_prompt.select("n", "wins", "key", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("r"))
    weight = poisson_weight(F.concat(F.lit(f"{seed}:"), F.col("key"), F.lit(":"), F.col("r").cast("string")))
    sums = drawn.select("r", (weight * F.col("n")).alias("n"), (weight * F.col("wins")).alias("wins")).groupBy("r").agg(
        F.sum("n").alias("n"), F.sum("wins").alias("wins")
    )
    rates = sums.select(F.when(F.col("n") > 0, F.col("wins") / F.col("n")).alias("rate"), F.lit(None).cast("int").alias("win"))
    # Point counts and replicate rates in one aggregation: the verdict rows carry no rate.
    rows = rates.unionByName(valid.select(F.lit(None).cast("double").alias("rate"), "win"))
    low, high = (1 - level) / 2, 1 - (1 - level) / 2
    found = rows.agg(
        F.count("win").cast("long").alias("evaluated_preferences"),
        F.coalesce(F.sum("win"), F.lit(0)).cast("long").alias("ppo_wins"),
        (F.lit(replicates) - F.count("rate")).cast("long").alias("empty_replicates"),
        F.percentile("rate", F.array(F.lit(low), F.lit(high))).alias("ends"),
        F.stddev_samp("rate").alias("std_error"),
    )
    return found.select(
        "evaluated_preferences", "ppo_wins",
        F.when(F.col("evaluated_preferences") > 0, F.col("ppo_wins") / F.col("evaluated_preferences")).alias("ppo_win_rate"),
        F.lit(replicates).cast("long").alias("replicates"), "empty_replicates",
        F.col("ends")[0].alias("ci_low"), F.col("ends")[1].alias("ci_high"), "std_error",
    )


def _one_label_each(ratings: DataFrame) -> DataFrame:
    """(item, rater, label) with one label per item and rater; items a rater labelled twice
    differently are left out for that rater, repeats of the same label count once."""
    rated = ratings.where(F.col("item").isNotNull() & F.col("rater").isNotNull() & F.col("label").isNotNull())
    return rated.groupBy("item", "rater").agg(F.min("label").alias("label"), F.max("label").alias("other")).where(
        F.col("label") == F.col("other")
    ).drop("other")


def rater_contingency(ratings: DataFrame) -> DataFrame:
    """Counts of (label of rater a, label of rater b) over items both rated, for every pair a < b."""
    once = _one_label_each(ratings)
    a = once.select("item", F.col("rater").alias("rater_a"), F.col("label").alias("label_a"))
    b = once.select("item", F.col("rater").alias("rater_b"), F.col("label").alias("label_b"))
    pairs = a.join(b, "item").where(F.col("rater_a") < F.col("rater_b"))
    return pairs.groupBy("rater_a", "rater_b", "label_a", "label_b").agg(F.count(F.lit(1)).alias("n"))


def rater_agreement(ratings: DataFrame) -> DataFrame:
    """Cohen's kappa of every pair of raters over the items both rated.

    ``ratings``: item, rater, label (rows with a null in any are no rating).
    Result: rater_a, rater_b, n_items, n_agree, p_observed, p_expected, kappa. When chance
    agreement is 1 (both raters gave one and the same label throughout) kappa is 1.0.
    Pairs of raters without common items have no row.
    """
    cells = rater_contingency(ratings)
    pair = ["rater_a", "rater_b"]
    totals = cells.groupBy(pair).agg(F.sum("n").alias("n_items"), F.sum(F.when(F.col("label_a") == F.col("label_b"), F.col("n")).otherwise(0)).alias("n_agree"))
    rows = cells.groupBy(*pair, F.col("label_a").alias("label")).agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy(*pair, F.col("label_b").alias("label")).agg(F.sum("n").alias("col_n"))
    chance = rows.join(cols, [*pair, "label"]).groupBy(pair).agg(F.sum(F.col("row_n") * F.col("col_n")).alias("expected"))
    joined = totals.join(chance, pair, "left")
    p_o = F.col("n_agree") / F.col("n_items")
    p_e = F.coalesce(F.col("expected"), F.lit(0)) / (F.col("n_items") * F.col("n_items"))
    return joined.select(
        *pair, F.col("n_items").cast("long").alias("n_items"), F.col("n_agree").cast("long").alias("n_agree"),
        p_o.alias("p_observed"), p_e.alias("p_expected"),
        F.when(p_e >= 1, F.lit(1.0)).otherwise((p_o - p_e) / (1 - p_e)).alias("kappa"),
    )


#: Blanks between words, the same in SQL: Java's and RE2's ``\s`` differ on U+000B.
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def response_diagnostics(responses: DataFrame, labels: DataFrame, n: int = 3) -> DataFrame:
    """Per response: n_words, n_distinct, distinct_share, n_repeated (``n``-grams seen before
    in the same text), repeat_share, and ``toxic`` from ``labels`` (null when unlabelled).

    ``responses``: doc_id, text. Words are the blank-separated pieces; a null text has none.
    Shares are null without words (or without ``n``-grams). Repeated rows give repeated rows;
    a doc_id labelled twice takes the largest label. Very long texts are read whole.
    """
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), BLANKS), lambda w: w != "")

    def measured(w: Column) -> Column:
        count = F.size(w)
        grams = F.transform(F.sequence(F.lit(1), F.greatest(count - n + 1, F.lit(0))), lambda i: F.array_join(F.slice(w, i, n), " "))
        grams = F.when(count >= n, grams).otherwise(F.array().cast("array<string>"))
        return F.struct(
            count.cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.size(grams).cast("long").alias("n_grams"),
            (F.size(grams) - F.size(F.array_distinct(grams))).cast("long").alias("n_repeated"),
        )

    measures = responses.select(responses["doc_id"].alias("doc_id"), _bound(words, measured).alias("m")).select("doc_id", "m.*")
    toxic = labels.groupBy(labels["doc_id"].alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    return measures.join(toxic, "doc_id", "left").select(
        "doc_id", "n_words", "n_distinct",
        F.when(F.col("n_words") > 0, F.col("n_distinct") / F.col("n_words")).alias("distinct_share"),
        "n_repeated",
        F.when(F.col("n_grams") > 0, F.col("n_repeated") / F.col("n_grams")).alias("repeat_share"),
        F.col("toxic").cast("int").alias("toxic"),
    )


def _one_verdict(verdicts: DataFrame) -> DataFrame:
    """prompt_id, verdict: one valid verdict per prompt; a prompt with two different ones has none."""
    valid = verdicts.where(F.col("verdict").isin("A", "B"))
    return valid.groupBy("prompt_id").agg(F.min("verdict").alias("verdict"), F.max("verdict").alias("other")).where(
        F.col("verdict") == F.col("other")
    ).drop("other")


def position_bias(forward: DataFrame, swapped: DataFrame) -> DataFrame:
    """Agreement of the judge with itself when the answers change places.

    ``forward``: prompt_id, verdict with the first policy as A; ``swapped``: the same prompts
    asked with the second policy as A. A prompt is consistent when both orders name the same
    policy (A then B, or B then A). Result, one row: n_prompts (with a valid verdict in any
    order), n_both, n_consistent, consistency (null without pairs), first_side_rate (share
    of A among all valid verdicts), missing_forward, missing_swapped, ambiguous (prompts with
    two different verdicts in one order; they count as missing there).
    """
    counted = lambda df, side: df.where(F.col("verdict").isin("A", "B")).groupBy("prompt_id").agg(
        (F.countDistinct("verdict") > 1).cast("int").alias(f"ambiguous_{side}")
    )
    f = _one_verdict(forward).select("prompt_id", F.col("verdict").alias("f"))
    s = _one_verdict(swapped).select("prompt_id", F.col("verdict").alias("s"))
    amb = counted(forward, "f").join(counted(swapped, "s"), "prompt_id", "full")
    both = f.join(s, "prompt_id", "full").join(amb, "prompt_id", "full")
    a_count = F.count_if(F.col("f") == "A") + F.count_if(F.col("s") == "A")
    valid = F.count("f") + F.count("s")
    return both.agg(
        F.count_if(F.col("f").isNotNull() | F.col("s").isNotNull()).cast("long").alias("n_prompts"),
        F.count_if(F.col("f").isNotNull() & F.col("s").isNotNull()).cast("long").alias("n_both"),
        F.count_if(F.col("f") != F.col("s")).cast("long").alias("n_consistent"),
        F.count_if((F.col("f") != F.col("s"))).alias("_c"),
        F.count_if(F.col("f").isNotNull() & F.col("s").isNotNull()).alias("_b"),
        a_count.alias("_a"), valid.alias("_v"),
        F.count_if(F.col("f").isNull() & F.col("s").isNotNull()).cast("long").alias("missing_forward"),
        F.count_if(F.col("s").isNull() & F.col("f").isNotNull()).cast("long").alias("missing_swapped"),
        F.count_if((F.coalesce("ambiguous_f", F.lit(0)) + F.coalesce("ambiguous_s", F.lit(0))) > 0).cast("long").alias("ambiguous"),
    ).select(
        "n_prompts", "n_both", "n_consistent",
        F.when(F.col("_b") > 0, F.col("_c") / F.col("_b")).alias("consistency"),
        F.when(F.col("_v") > 0, F.col("_a") / F.col("_v")).alias("first_side_rate"),
        "missing_forward", "missing_swapped", "ambiguous",
    )
