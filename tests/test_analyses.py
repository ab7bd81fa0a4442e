"""Bootstrap interval of the win rate and agreement of raters."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from prefspark.operators import analyses as A

JUDGED = "prompt_id long, verdict string, reward double"
RATINGS = "item long, rater string, label string"


def test_poisson_weights_follow_the_distribution(spark):
    cdf = A.poisson_one_cdf()
    assert cdf == sorted(cdf) and cdf[0] == pytest.approx(math.exp(-1)) and cdf[-1] < 1.0
    drawn = spark.range(200_000).select(A.poisson_weight(F.col("id").cast("string")).alias("w"))
    mean, var = drawn.agg(F.avg("w"), F.var_pop("w")).first()
    assert mean == pytest.approx(1.0, abs=0.01) and var == pytest.approx(1.0, abs=0.02)


def test_bootstrap_is_the_same_for_any_partitioning(spark):
    rows = [(i, "B" if i % 3 else "A", 1.0) for i in range(300)] + [(None, "B", 1.0), (5, "tie", 1.0), (7, None, 1.0)]
    df = spark.createDataFrame(rows, JUDGED)
    one = A.winrate_bootstrap(df.coalesce(1), 200).first()
    many = A.winrate_bootstrap(df.repartition(7), 200).first()
    # Interval and counts are equal; the deviation is a sum of doubles, equal up to its order.
    assert one[:7] == many[:7] and one.std_error == pytest.approx(many.std_error, rel=1e-12)
    assert one.evaluated_preferences == 301 and one.ppo_wins == 201
    assert one.ci_low < one.ppo_win_rate < one.ci_high and one.empty_replicates == 0
    assert one.std_error == pytest.approx(math.sqrt(0.667 * 0.333 / 301), rel=0.25)


def test_bootstrap_of_no_verdicts_and_of_one_prompt(spark):
    none = A.winrate_bootstrap(spark.createDataFrame([(1, "x", 1.0)], JUDGED), 50).first()
    assert (none.evaluated_preferences, none.ppo_wins, none.ppo_win_rate, none.empty_replicates, none.ci_low) == (0, 0, None, 50, None)
    one = A.winrate_bootstrap(spark.createDataFrame([(1, "B", 1.0), (1, "B", 2.0)], JUDGED), 100).first()
    # Both rows share a prompt, so they are drawn together; a replicate either sees them or is empty.
    assert one.ci_low == one.ci_high == 1.0 and 20 < one.empty_replicates < 55


def test_kappa_by_hand(spark):
    rows = [(1, "a", "y"), (1, "b", "y"), (2, "a", "y"), (2, "b", "n"), (3, "a", "n"), (3, "b", "n"), (4, "a", "n"), (4, "b", "n")]
    rows += [(4, "b", "n"), (5, "a", "y"), (5, "a", "n"), (5, "b", "y"), (6, "a", None), (6, "b", "y"), (None, "a", "y")]
    got = A.rater_agreement(spark.createDataFrame(rows, RATINGS)).first()
    assert (got.rater_a, got.rater_b, got.n_items, got.n_agree) == ("a", "b", 4, 3)
    assert (got.p_observed, got.p_expected, got.kappa) == (0.75, 0.5, 0.5)


def test_kappa_of_one_class_and_empty(spark):
    same = spark.createDataFrame([(i, r, "y") for i in range(3) for r in ("a", "b")], RATINGS)
    assert A.rater_agreement(same).first().kappa == 1.0
    assert A.rater_agreement(spark.createDataFrame([], RATINGS)).collect() == []
    apart = spark.createDataFrame([(1, "a", "y"), (2, "b", "y")], RATINGS)
    assert A.rater_agreement(apart).collect() == []


def test_response_diagnostics(spark):
    responses = spark.createDataFrame(
        [(1, "a b c a b c a"), (2, None), (3, "one  two"), (3, "one  two"), (4, "x " * 20000), (5, "\x0bq\x0b")],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = sorted(A.response_diagnostics(responses, labels).collect(), key=lambda r: r.doc_id)
    # a b c a b c a: trigrams abc bca cab abc bca -> two repeat an earlier one.
    assert tuple(got[0]) == (1, 7, 3, 3 / 7, 2, 2 / 5, 1)
    assert tuple(got[1]) == (2, 0, 0, None, 0, None, None)
    assert tuple(got[2]) == tuple(got[3]) == (3, 2, 2, 1.0, 0, None, 0)
    assert tuple(got[4])[:5] == (4, 20000, 1, 1 / 20000, 19997)
    assert tuple(got[5])[:3] == (5, 1, 1)


def test_position_bias(spark):
    schema = "prompt_id long, verdict string"
    forward = spark.createDataFrame([(1, "A"), (2, "B"), (3, "A"), (4, None), (5, "B"), (6, "A"), (6, "B"), (7, "A")], schema)
    swapped = spark.createDataFrame([(1, "B"), (2, "B"), (3, None), (4, "A"), (5, "A"), (6, "A"), (7, "A"), (7, "A")], schema)
    got = A.position_bias(forward, swapped).first()
    # Pairs: 1 (A, B) consistent, 2 (B, B) not, 5 (B, A) consistent, 7 (A, A) not; 6 is ambiguous forward.
    assert (got.n_prompts, got.n_both, got.n_consistent, got.consistency) == (7, 4, 2, 0.5)
    assert (got.missing_forward, got.missing_swapped, got.ambiguous) == (2, 1, 1)
    assert got.first_side_rate == 7 / 11  # one verdict per prompt and order: 3 of 5 forward, 4 of 6 swapped
    empty = A.position_bias(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).first()
    assert (empty.n_prompts, empty.consistency, empty.first_side_rate) == (0, None, None)
