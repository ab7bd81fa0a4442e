"""Judge requests, and win rates and rating errors from judge replies.

Answers, verdicts, ratings and rewards are tables keyed by ``prompt_id``. The first
policy is always side A and the second always side B.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.judge import (
    parse_rating,
    parse_verdict,
    preference_request,
    rating_request,
)
from prefspark.operators.ordinals import dense_ordinal
from prefspark.storage import durable


def judge_requests(answers: DataFrame) -> DataFrame:
    """The two requests per prompt: compare both answers, rate the second one.

    One pass over the answers makes both kinds.
    """
    prompt, first, second = F.col("prompt"), F.col("sft_answer"), F.col("ppo_answer")
    requests = F.array(
        F.struct(
            F.lit("preference").alias("kind"),
            F.lit(D.PREFERENCE_SYSTEM).alias("system"),
            preference_request(prompt, first, second).alias("user"),
        ),
        F.struct(
            F.lit("rating").alias("kind"),
            F.lit(D.RATING_SYSTEM).alias("system"),
            rating_request(prompt, second).alias("user"),
        ),
    )
    return answers.select("prompt_id", F.inline(requests))


def one_per_prompt(table: DataFrame, name: str) -> DataFrame:
    """``table`` as it is, or an error naming the first prompt it holds twice.

    The check runs in the job that reads the table: its grouping is by ``prompt_id``, which
    the joins that follow need anyway.
    """
    values = [c for c in table.columns if c != "prompt_id"]
    grouped = table.groupBy("prompt_id").agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in values])
    message = F.concat(F.lit(f"{name}: prompt "), F.coalesce(F.col("prompt_id").cast("string"), F.lit("null")),
                       F.lit(" has "), F.col("_rows").cast("string"), F.lit(" rows; each prompt needs one"))
    return grouped.where(F.assert_true(F.col("_rows") == 1, message).isNull()).select("prompt_id", *values)


def paired_answers(
    sft_answers: DataFrame,
    ppo_answers: DataFrame,
    verdicts: DataFrame,
    ratings: DataFrame,
    rewards: DataFrame,
) -> DataFrame:
    """Both answers of each prompt with the judge's replies; a missing reply is null.

    Every table must hold a prompt once: a doubled reply would count its verdict twice, so it
    ends the job with an error that names the table and the prompt.
    """
    return (
        one_per_prompt(sft_answers, "first answers")
        .join(one_per_prompt(ppo_answers, "second answers"), "prompt_id")
        .join(one_per_prompt(verdicts, "verdicts"), "prompt_id", "left")
        .join(one_per_prompt(ratings, "ratings"), "prompt_id", "left")
        .join(one_per_prompt(rewards, "rewards"), "prompt_id", "left")
    )


def parse_judgements(judged: DataFrame) -> DataFrame:
    """Add ``verdict`` and ``judge_score``, null where malformed."""
    return judged.withColumn("verdict", parse_verdict(F.col("verdict_raw"))).withColumn(
        "judge_score", parse_rating(F.col("score_raw"))
    )


def _has_verdict() -> Column:
    return F.col("verdict").isNotNull()


def _has_scores() -> Column:
    return F.col("judge_score").isNotNull() & F.col("reward").isNotNull()


def rating_errors(judgements: DataFrame) -> DataFrame:
    """Absolute difference of rating and reward for prompts where both are known.

    A malformed verdict skips its prompt altogether.
    """
    return judgements.where(_has_verdict() & _has_scores()).select(
        "prompt_id",
        "judge_score",
        "reward",
        F.abs(F.col("judge_score") - F.col("reward")).alias("abs_error"),
    )


def ordered_errors(judgements: DataFrame) -> DataFrame:
    """The error list in prompt order: position and error, one row each.

    Numbering reads its input several times, so the narrow error rows are stored first.
    """
    stored = durable(rating_errors(judgements).select("prompt_id", "abs_error"))
    errors = dense_ordinal(stored, ["prompt_id"], "sample")
    return errors.select((F.col("sample") - 1).alias("sample"), "prompt_id", "abs_error")


def error_profile(judgements: DataFrame) -> DataFrame:
    """Size, mean, range and deviation of the errors."""
    return rating_errors(judgements).agg(
        F.count("abs_error").alias("n_errors"),
        F.avg("abs_error").alias("mean_error"),
        F.min("abs_error").alias("min_error"),
        F.max("abs_error").alias("max_error"),
        F.stddev_pop("abs_error").alias("std_error"),
    )


def win_counts() -> list[Column]:
    return [
        F.count_if(F.col("verdict") == "A").alias("sft_wins"),
        F.count_if(F.col("verdict") == "B").alias("ppo_wins"),
    ]


def skipped_counts() -> list[Column]:
    """Prompts without a verdict, and prompts with one that lack a rating or a reward."""
    return [
        F.count_if(~_has_verdict()).alias("skipped_preferences"),
        F.count_if(_has_verdict() & ~_has_scores()).alias("skipped_scores"),
    ]


def with_win_rate(counts: DataFrame) -> DataFrame:
    """Add the number of valid verdicts and the share of side B; 0.0 without any."""
    evaluated = F.col("sft_wins") + F.col("ppo_wins")
    rate = F.when(evaluated == 0, F.lit(0.0)).otherwise(F.col("ppo_wins") / evaluated)
    return counts.withColumn("evaluated_preferences", evaluated).withColumn("ppo_win_rate", rate)


def evaluation_summary(judgements: DataFrame) -> DataFrame:
    """All counts and metrics of an evaluation in one row and one aggregate."""
    valid = _has_verdict() & _has_scores()
    error = F.when(valid, F.abs(F.col("judge_score") - F.col("reward")))
    return with_win_rate(
        judgements.agg(
            *win_counts(),
            *skipped_counts(),
            F.count(error).alias("n_errors"),
            F.avg(error).alias("mean_error"),
        )
    )
