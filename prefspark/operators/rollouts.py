"""Token-level quantities of logged rollouts: one row per ``(rollout_id, pos)``.

Windows run over a whole rollout only if none is longer than ``SEGMENT_TOKENS``: then one
shuffle by rollout serves all of them. A longer rollout may be a large share of the table.
If there is one, windows run over segments of ``SEGMENT_TOKENS`` positions, and what a
segment needs from the rest of its rollout, a handful of numbers, comes from a table with
one row per segment. Positions count from 0 without gaps.

A row holds the statistics with which the token *after* it was chosen, so a sequence of ``L``
tokens has ``L - 1`` rows, and the response's rows start at ``prompt_length - 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.losses import clipped_surrogate, drift_penalty

SEGMENT_TOKENS = 65_536
_TOKEN = ["rollout_id", "pos"]
_SEGMENT = ["rollout_id", "_segment"]


def _segment(tokens: int) -> Column:
    return F.expr(f"pos div {int(tokens)}")


def align_reference(policy: DataFrame, reference: DataFrame) -> DataFrame:
    """Policy and frozen-reference statistics of the same tokens."""
    return policy.join(reference, _TOKEN)


def unmatched_tokens(policy: DataFrame, reference: DataFrame) -> DataFrame:
    """Policy tokens the reference has no statistics for."""
    return policy.join(reference, _TOKEN, "left_anti")


def response_tokens(tokens: DataFrame) -> DataFrame:
    """Rows whose statistics concern the response; each predicts the token after it."""
    return tokens.where(F.col("pos") >= F.col("prompt_length") - 1)


def generated_counts(tokens: DataFrame) -> DataFrame:
    """Rows in all and rows of generated tokens, as in :func:`response_tokens`, per rollout."""
    return tokens.groupBy("rollout_id").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count_if(F.col("pos") >= F.col("prompt_length") - 1).alias("n_generated"),
    )


def drift_rewards(tokens: DataFrame, beta: float = D.KL_COEFFICIENT) -> DataFrame:
    """Add the drift penalty of each token as ``token_reward``."""
    return tokens.withColumn("token_reward", drift_penalty(F.col("old_lp"), F.col("ref_lp"), beta))


def add_terminal_rewards(tokens: DataFrame, terminal: DataFrame) -> DataFrame:
    """Add ``terminal_reward`` to the last token of each rollout.

    The last positions come from an aggregate; the join on the token key spreads a long
    rollout over all tasks.
    """
    ends = (
        tokens.groupBy("rollout_id").agg(F.max("pos").alias("pos")).join(terminal, "rollout_id")
    )
    return (
        tokens.join(ends, _TOKEN, "left")
        .withColumn(
            "token_reward",
            F.col("token_reward") + F.coalesce(F.col("terminal_reward"), F.lit(0.0)),
        )
        .drop("terminal_reward")
    )


def _has_long_rollout(tokens: DataFrame, segment_tokens: int) -> bool:
    """Whether any position lies beyond the first segment; a pushed-down filter."""
    return not tokens.where(F.col("pos") >= segment_tokens).isEmpty()


def _tail_sum(column: str, keys: list[str]) -> Column:
    """Sum from a row to the end of its partition.

    Descending order with a growing frame is linear; a frame that reaches from the
    current row to the end is summed anew for every row.
    """
    backwards = Window.partitionBy(*keys).orderBy(F.desc("pos"))
    return F.sum(column).over(backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _later_sum(column: str) -> Column:
    """Sum over the segments that follow in the rollout."""
    following = Window.partitionBy("rollout_id").orderBy(F.desc("_segment"))
    total = F.sum(column).over(following.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(total, F.lit(0.0))


def _over_rollout(total: Column) -> Column:
    return total.over(Window.partitionBy("rollout_id"))


def returns_to_go(tokens: DataFrame, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Add ``ret``: the undiscounted sum of ``token_reward`` from each token to the end."""
    if not _has_long_rollout(tokens, segment_tokens):
        return tokens.withColumn("ret", _tail_sum("token_reward", ["rollout_id"]))
    placed = tokens.withColumn("_segment", _segment(segment_tokens))
    later = (
        placed.groupBy(*_SEGMENT)
        .agg(F.sum("token_reward").alias("_sum"))
        .withColumn("_later", _later_sum("_sum"))
        .drop("_sum")
    )
    return (
        placed.withColumn("_tail", _tail_sum("token_reward", _SEGMENT))
        .join(later, _SEGMENT)
        .withColumn("ret", F.col("_tail") + F.col("_later"))
        .drop("_segment", "_tail", "_later")
    )


def _rollout_moments(segments: DataFrame) -> DataFrame:
    """Add rows, mean and population deviation of each rollout from those of its segments.

    Reads ``_rows, _m, _v``: size, mean and variance of a segment.
    """
    total = _over_rollout(F.sum("_rows"))
    mean = _over_rollout(F.sum(F.col("_rows") * F.col("_m"))) / total
    spread = F.col("_v") + F.pow(F.col("_m") - F.col("_mean"), F.lit(2.0))
    variance = _over_rollout(F.sum(F.col("_rows") * spread)) / F.col("_total")
    return (
        segments.withColumns({"_total": total, "_mean": mean})
        .withColumn("_std", F.sqrt(variance))
        .drop("_rows", "_m", "_v")
    )


def _with_advantage(tokens: DataFrame) -> DataFrame:
    """Add ``advantage`` from ``ret``, ``val`` and the moments of ``ret - val``."""
    gap = F.col("ret") - F.col("val")
    scaled = (gap - F.col("_mean")) / (F.col("_std") + F.lit(D.STD_EPSILON))
    return tokens.withColumn(
        "advantage", F.when(F.col("_total") > 1, scaled).otherwise(gap)
    ).drop("_total", "_mean", "_std")


def _normalised_in_rollout(tokens: DataFrame) -> DataFrame:
    gap = F.col("ret") - F.col("val")
    return _with_advantage(
        tokens.withColumns(
            {
                "_total": _over_rollout(F.count(F.lit(1))),
                "_mean": _over_rollout(F.avg(gap)),
                "_std": _over_rollout(F.stddev_pop(gap)),
            }
        )
    )


def _segment_moments(value: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.avg(value).alias("_m"),
        F.var_pop(value).alias("_v"),
    ]


def normalize_advantages(tokens: DataFrame, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Add ``advantage``: ``ret - val``, normalised over each rollout with several tokens."""
    if not _has_long_rollout(tokens, segment_tokens):
        return _normalised_in_rollout(tokens)
    placed = tokens.withColumn("_segment", _segment(segment_tokens))
    segments = placed.groupBy(*_SEGMENT).agg(*_segment_moments(F.col("ret") - F.col("val")))
    joined = placed.join(_rollout_moments(segments), _SEGMENT)
    return _with_advantage(joined).drop("_segment")


def returns_and_advantages(
    tokens: DataFrame, terminal: DataFrame, segment_tokens: int = SEGMENT_TOKENS
) -> DataFrame:
    """Add ``terminal_reward``, ``ret`` and ``advantage``.

    The terminal reward is part of the last token's reward, so it is part of every return.
    """
    reward = F.coalesce(F.col("terminal_reward"), F.lit(0.0))
    if not _has_long_rollout(tokens, segment_tokens):
        rewarded = tokens.join(terminal, "rollout_id", "left").withColumn("terminal_reward", reward)
        tail = _tail_sum("token_reward", ["rollout_id"])
        return _normalised_in_rollout(rewarded.withColumn("ret", tail + F.col("terminal_reward")))

    # Inside a segment the return differs from the local tail sum by one number, _level: the
    # rewards of later segments plus the terminal reward. It moves the mean of the segment
    # and leaves its variance, so tokens meet the segment table once.
    placed = tokens.withColumn("_segment", _segment(segment_tokens))
    local = placed.withColumn("_tail", _tail_sum("token_reward", _SEGMENT))
    segments = (
        local.groupBy(*_SEGMENT)
        .agg(
            F.sum("token_reward").alias("_sum"),
            *_segment_moments(F.col("_tail") - F.col("val")),
        )
        .join(terminal, "rollout_id", "left")
        .withColumn("terminal_reward", reward)
        .withColumn("_level", _later_sum("_sum") + F.col("terminal_reward"))
        .withColumn("_m", F.col("_m") + F.col("_level"))
        .drop("_sum")
    )
    joined = local.join(_rollout_moments(segments), _SEGMENT).withColumn(
        "ret", F.col("_tail") + F.col("_level")
    )
    return _with_advantage(joined).drop("_segment", "_tail", "_level")


def next_tokens(tokens: DataFrame, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Pair each position with the token after it; the last position has none and drops out.

    The first token of a segment is also sent to the segment before it, where it serves
    as the next token of the last row and is then removed.
    """
    size = int(segment_tokens)
    home = _segment(size)
    homes = F.when(
        (F.col("pos") % size == 0) & (F.col("pos") > 0), F.array(home, home - 1)
    ).otherwise(F.array(home))
    forward = Window.partitionBy(*_SEGMENT).orderBy("pos")
    return (
        tokens.withColumn("_segment", F.explode(homes))
        .withColumn("next_token_id", F.lead("token_id").over(forward))
        .where((F.col("_segment") == _segment(size)) & F.col("next_token_id").isNotNull())
        .drop("_segment")
    )


def surrogates(tokens: DataFrame, epsilon: float = D.CLIP_EPSILON) -> DataFrame:
    """Add the clipped surrogate of each token."""
    return tokens.withColumn(
        "surrogate",
        clipped_surrogate(F.col("lp"), F.col("old_lp"), F.col("advantage"), epsilon),
    )


def _policy_loss() -> Column:
    return -F.avg("surrogate")


def _value_loss() -> Column:
    return F.avg(F.pow(F.col("new_val") - F.col("ret"), F.lit(2.0)))


def policy_losses(tokens: DataFrame, epsilon: float = D.CLIP_EPSILON) -> DataFrame:
    """Minus the mean clipped surrogate, per rollout."""
    return (
        surrogates(tokens, epsilon).groupBy("rollout_id").agg(_policy_loss().alias("policy_loss"))
    )


def value_losses(tokens: DataFrame) -> DataFrame:
    """Mean squared difference of value and return, per rollout."""
    return tokens.groupBy("rollout_id").agg(_value_loss().alias("value_loss"))


def rollout_metrics(
    tokens: DataFrame,
    epsilon: float = D.CLIP_EPSILON,
    value_coefficient: float = D.VALUE_COEFFICIENT,
) -> DataFrame:
    """Terminal reward and losses, one row per rollout, in one aggregate."""
    return (
        surrogates(tokens, epsilon)
        .groupBy("rollout_id")
        .agg(
            F.count(F.lit(1)).alias("n_tokens"),
            F.max("terminal_reward").alias("terminal_reward"),
            _policy_loss().alias("policy_loss"),
            _value_loss().alias("value_loss"),
        )
        .withColumn(
            "loss", F.col("policy_loss") + F.lit(float(value_coefficient)) * F.col("value_loss")
        )
    )
