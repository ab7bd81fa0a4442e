"""Chats as long tables with one row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURNS_PER_PART = 1024


def assemble_conversations(turns: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """Fold turns into ordered message arrays.

    A chat gets one row per ``turns_per_part`` positions. Nearly every chat has one part;
    a huge one is spread over many rows and tasks instead of filling one array.
    """
    message = F.struct("turn", "role", F.col("text").alias("content"))
    return (
        turns.withColumn("part", F.expr(f"turn div {int(turns_per_part)}"))
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(message)).alias("messages"))
    )


def _first_text(condition):
    return F.min_by("text", F.when(condition, F.col("turn")))


def _last_text(condition):
    return F.max_by("text", F.when(condition, F.col("turn")))


def final_responses(turns: DataFrame) -> DataFrame:
    """Final response per chat; null where neither rule finds any text.

    The state of each aggregate is one text, so a long chat is reduced before the shuffle.
    """
    answered = (F.col("role") == "assistant") & (F.col("text") != "")
    last = F.nullif(F.max_by("text", "turn"), F.lit(""))
    return turns.groupBy("conv_id").agg(F.coalesce(_last_text(answered), last).alias("response"))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """First user text with the last and the first assistant text as the two answers."""
    answered = F.col("role") == "assistant"
    return (
        turns.groupBy(F.col("conv_id").alias("pair_id"))
        .agg(
            _first_text(F.col("role") == "user").alias("prompt"),
            _last_text(answered).alias("chosen"),
            _first_text(answered).alias("rejected"),
            F.count_if(answered).alias("_answers"),
        )
        .where(F.col("_answers") >= 2)
        .drop("_answers")
    )
