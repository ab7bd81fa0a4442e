"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.operators.conversations import preference_pairs
from prefspark.operators.ordinals import ordinal_within
from prefspark.operators.vocabulary import build_vocabulary
from prefspark.storage import durable

VOCABULARY_SIZE = None  # all words

#: Rows with whole texts that one task numbers: groups are a few languages, and most of the table.
TEXT_ROWS_PER_BUCKET = 16_384


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pair_id, prompt, chosen, rejected`` as text, one row per chat with two answers."""
    return preference_pairs(table(spark, sf_dir, "conversations"))


def nested_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference table with message arrays; pair_id % 7 selects a shape or a defect."""

    def message(role: str, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    case = F.expr("pair_id % 7")
    prompt, chosen = F.col("prompt"), F.col("chosen")
    asked = message("user", prompt)
    answered = F.array(asked, message("assistant", chosen))
    response = (
        F.when(case == 1, F.array(asked, message("assistant", chosen), message("assistant", F.lit(""))))
        .when(case == 2, F.array(asked, message("tool", chosen)))
        .when(case == 3, F.lit(None))
        .when(case == 4, F.slice(answered, 1, 0))
        .when(case == 5, F.array(message("user", F.lit("")), message("assistant", F.lit(""))))
        .otherwise(answered)
    )
    return chat_pairs(spark, sf_dir).select(
        "pair_id",
        F.when(case != 6, prompt).alias("prompt"),
        response.alias("chosen"),
        F.array(asked, message("assistant", F.col("rejected"))).alias("rejected"),
    )


def topic_prompt():
    return F.concat(F.lit("Write about "), F.col("source"), F.lit(" in "), F.col("lang"))


def sft_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good documents as chosen answers to a prompt about their source and language."""
    good = table(spark, sf_dir, "labels").where(F.col("quality") == 1).select("doc_id")
    return (
        table(spark, sf_dir, "documents")
        .join(good, "doc_id")
        .select(
            F.col("doc_id").alias("pair_id"), topic_prompt().alias("prompt"),
            F.col("text").alias("chosen"),
        )
    )


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n-th good document of a language against its n-th other document."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left")
        .withColumn("good", F.coalesce(F.col("quality") == 1, F.lit(False)))
        .select("doc_id", "lang", "good", topic_prompt().alias("prompt"), "text")
    )
    ranked = ordinal_within(documents, ["lang", "good"], ["doc_id"], "slot", TEXT_ROWS_PER_BUCKET)
    chosen = ranked.where("good").select(
        "lang", "slot", F.col("doc_id").alias("pair_id"), "prompt", F.col("text").alias("chosen")
    )
    rejected = ranked.where("not good").select("lang", "slot", F.col("text").alias("rejected"))
    return chosen.join(rejected, ["lang", "slot"]).drop("lang", "slot")


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One token per event, in time order of each user."""
    events = ordinal_within(
        table(spark, sf_dir, "events").select("event_id", "user_id", "ts"),
        ["user_id"],
        ["ts", "event_id"],
    )
    return events.selectExpr(
        "user_id AS rollout_id",
        "ordinal - 1 AS pos",
        "event_id % 1000 AS token_id",
        "-(4 + event_id % 13) * 0.1D AS old_lp",
        "-(4 + event_id % 13) * 0.1D + (event_id % 7 - 3) * 0.1D AS lp",
        "-(4 + event_id % 13) * 0.1D - (event_id % 5 - 2) * 0.02D AS ref_lp",
        "(event_id % 11 - 5) * 0.1D AS val",
        "(event_id % 11 - 5) * 0.1D + (event_id % 3 - 1) * 0.05D AS new_val",
        "1 + user_id % 8 AS prompt_length",
    )


def logged_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollouts as a stored table, for queries that read them more than once."""
    return durable(rollouts(spark, sf_dir))


def terminal_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reward per rollout."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.selectExpr(
        "user_id AS rollout_id", "CAST(user_id % 9 - 4 AS DOUBLE) AS terminal_reward"
    )


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prompt_id, verdict_raw, score_raw, reward`` with well-formed and malformed replies."""
    return table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS prompt_id",
        r"""element_at(array('A', ' b ', 'tie', NULL, 'B', 'a', 'B.', '\tB\n'),
            CAST(doc_id % 8 + 1 AS INT)) AS verdict_raw""",
        """element_at(array('4', ' 3.5 ', 'nan', '5.5', 'four', '4d', NULL, '1', '5.0', '0.99', '2e0'),
            CAST(doc_id % 11 + 1 AS INT)) AS score_raw""",
        "CASE WHEN doc_id % 13 <> 0 THEN quality + 1.5D - toxic END AS reward",
    )


def swapped_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prompt_id, verdict_raw`` of the same prompts asked with the answers in the other order."""
    return table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS prompt_id",
        r"""element_at(array('B', 'A', ' a ', NULL, 'A', 'b', 'x', 'A', 'B'),
            CAST((doc_id * 3 + quality) % 9 + 1 AS INT)) AS verdict_raw""",
    )


def prompt_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First user text of each chat; every tenth prompt is missing."""
    first = F.min_by("text", F.when(F.col("role") == "user", F.col("turn")))
    return (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("prompt_id"))
        .agg(first.alias("Prompts"))
        .withColumn("Prompts", F.when(F.expr("prompt_id % 10 <> 0"), F.col("Prompts")))
    )


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocabulary(table(spark, sf_dir, "documents"), "text", VOCABULARY_SIZE)
