from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from prefspark.functions.losses import clipped_surrogate
from prefspark.operators import rollouts as R
from prefspark.plans.jobs import rollout_losses

COLUMNS = "rollout_id int, pos bigint, token_id int, old_lp double, ref_lp double, lp double, val double, new_val double, prompt_length int"


@pytest.fixture(scope="module")
def logged(spark):
    """Rollouts of very different lengths, one of them most of the table."""
    rng = random.Random(3)
    rows, terminal = [], {}
    for rollout, length in enumerate([1, 2, 7, 8, 9, 400, 30]):
        terminal[rollout] = rng.uniform(-3, 3)
        for pos in range(length):
            numbers = [rng.uniform(-2, 0) for _ in range(3)] + [rng.uniform(-1, 1) for _ in range(2)]
            rows.append((rollout, pos, rng.randrange(50), *numbers, min(1 + rollout, length)))
    frame = spark.createDataFrame(rows, COLUMNS).repartition(5).cache()
    rewards = spark.createDataFrame(list(terminal.items()), "rollout_id int, terminal_reward double")
    return rows, terminal, frame, rewards


def brute(rows, terminal, beta=0.005, epsilon=0.2, c=0.05):
    tokens, metrics = {}, {}
    for rollout in terminal:
        mine = sorted(r for r in rows if r[0] == rollout and r[1] >= r[8] - 1)
        reward = [-beta * (r[3] - r[4]) for r in mine]
        reward[-1] += terminal[rollout]
        returns = [math.fsum(reward[i:]) for i in range(len(reward))]
        raw = [g - r[6] for g, r in zip(returns, mine)]
        advantage = raw
        if len(raw) > 1:
            mean, std = statistics.fmean(raw), statistics.pstdev(raw)
            advantage = [(x - mean) / (std + 1e-8) for x in raw]
        surrogate = []
        for r, adv in zip(mine, advantage):
            ratio = math.exp(r[5] - r[3])
            surrogate.append(min(ratio * adv, min(max(ratio, 1 - epsilon), 1 + epsilon) * adv))
            tokens[rollout, r[1]] = (returns[len(surrogate) - 1], adv)
        policy = -statistics.fmean(surrogate)
        value = statistics.fmean((r[7] - g) ** 2 for r, g in zip(mine, returns))
        metrics[rollout] = (policy, value, policy + c * value)
    return tokens, metrics


@pytest.mark.parametrize("segment", [1, 3, 8, 65_536])
def test_returns_and_advantages(logged, segment):
    rows, terminal, frame, rewards = logged
    tokens, _ = brute(rows, terminal)
    rewarded = R.drift_rewards(R.response_tokens(frame))
    fused = R.returns_and_advantages(rewarded, rewards, segment)
    stepwise = R.normalize_advantages(
        R.returns_to_go(R.add_terminal_rewards(rewarded, rewards), segment), segment
    )
    for scored in (fused, stepwise):
        got = {(r["rollout_id"], r["pos"]): (r["ret"], r["advantage"]) for r in scored.collect()}
        assert got.keys() == tokens.keys()
        for key, want in tokens.items():
            assert got[key] == pytest.approx(want, abs=1e-9), key


@pytest.mark.parametrize("segment", [5, 65_536])
def test_metrics(logged, segment):
    rows, terminal, frame, rewards = logged
    _, metrics = brute(rows, terminal)
    got = rollout_losses(frame, rewards, segment_tokens=segment).collect()
    assert len(got) == len(metrics)
    for r in got:
        assert (r["policy_loss"], r["value_loss"], r["loss"]) == pytest.approx(
            metrics[r["rollout_id"]], abs=1e-9
        )
        assert r["terminal_reward"] == terminal[r["rollout_id"]]


@pytest.mark.parametrize("segment", [1, 4, 65_536])
def test_next_tokens(logged, segment):
    rows, _, frame, _ = logged
    by_key = {(r[0], r[1]): r[2] for r in rows}
    want = {k: by_key[k[0], k[1] + 1] for k in by_key if (k[0], k[1] + 1) in by_key}
    got = {(r["rollout_id"], r["pos"]): r["next_token_id"] for r in R.next_tokens(frame, segment).collect()}
    assert got == want


def test_undiscounted_return(spark):
    frame = spark.createDataFrame(
        [(0, 0, -0.1), (0, 1, -0.2), (0, 2, 1.0)], "rollout_id int, pos int, token_reward double"
    )
    got = [r["ret"] for r in R.returns_to_go(frame).orderBy("pos").collect()]
    assert got == pytest.approx([0.7, 0.8, 1.0])


def test_clipped_loss_inside_the_range(spark):
    rows = [(0, math.log(0.55), math.log(0.5), 1.0), (0, math.log(0.45), math.log(0.5), -1.0)]
    frame = spark.createDataFrame(rows, "rollout_id int, lp double, old_lp double, advantage double")
    assert R.policy_losses(frame, 0.2).first()["policy_loss"] == pytest.approx(-0.1)


@pytest.mark.parametrize(
    "ratio, advantage, expected",
    [(2.0, 1.0, 1.2), (2.0, -1.0, -2.0), (0.5, 1.0, 0.5), (0.5, -1.0, -0.8), (1.1, -2.0, -2.2)],
)
def test_clipping(one_row, ratio, advantage, expected):
    value = clipped_surrogate(F.lit(math.log(ratio)), F.lit(0.0), F.lit(advantage), 0.2)
    assert one_row(value)[0] == pytest.approx(expected)


def test_missing_partners_and_empty_responses(spark):
    policy = spark.createDataFrame([(1, 0, -1.0), (1, 1, -1.0)], "rollout_id int, pos int, old_lp double")
    reference = spark.createDataFrame([(1, 0, -2.0)], "rollout_id int, pos int, ref_lp double")
    assert [tuple(r) for r in R.align_reference(policy, reference).collect()] == [(1, 0, -1.0, -2.0)]
    assert [r["pos"] for r in R.unmatched_tokens(policy, reference).collect()] == [1]
    for prompt_length, generated in ((1, 2), (2, 1), (3, 0)):
        lengths = policy.withColumn("prompt_length", F.lit(prompt_length))
        assert tuple(R.generated_counts(lengths).first()) == (1, 2, generated)
        assert R.response_tokens(lengths).count() == generated
