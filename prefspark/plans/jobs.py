"""The three data jobs: training batches, rollout metrics, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from prefspark import defaults as D
from prefspark.operators import evaluation, rollouts, sft
from prefspark.operators.preferences import preference_examples


def sft_batches(
    preferences: DataFrame,
    vocabulary: DataFrame,
    max_length: int = D.MAX_LENGTH,
    batch_size: int = D.BATCH_SIZE,
) -> DataFrame:
    """Preference rows to padded, masked batches."""
    examples = preference_examples(preferences)
    encoded = sft.encode_examples(examples, vocabulary, max_length)
    return sft.padded_batches(sft.label_examples(encoded), batch_size)


def rollout_losses(
    tokens: DataFrame,
    terminal: DataFrame,
    *,
    beta: float = D.KL_COEFFICIENT,
    epsilon: float = D.CLIP_EPSILON,
    value_coefficient: float = D.VALUE_COEFFICIENT,
    segment_tokens: int = rollouts.SEGMENT_TOKENS,
) -> DataFrame:
    """Logged token statistics and terminal rewards to one row of losses per rollout."""
    rewarded = rollouts.drift_rewards(rollouts.response_tokens(tokens), beta)
    scored = rollouts.returns_and_advantages(rewarded, terminal, segment_tokens)
    return rollouts.rollout_metrics(scored, epsilon, value_coefficient)


def policy_comparison(
    sft_answers: DataFrame,
    ppo_answers: DataFrame,
    verdicts: DataFrame,
    ratings: DataFrame,
    rewards: DataFrame,
) -> DataFrame:
    """Answers and judge replies to the summary row."""
    judged = evaluation.paired_answers(sft_answers, ppo_answers, verdicts, ratings, rewards)
    return evaluation.evaluation_summary(evaluation.parse_judgements(judged))
