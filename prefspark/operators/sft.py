"""Encoded, masked and padded rows for supervised fine-tuning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.text import format_prompt, format_response
from prefspark.functions.tokens import attention_mask, mask_prompt, pad_right, truncate_for_sft
from prefspark.operators.ordinals import assign_batches
from prefspark.operators.vocabulary import encode_tokens
from prefspark.storage import durable


def format_examples(examples: DataFrame) -> DataFrame:
    """Prompt and chosen response in their templates."""
    return examples.select(
        "pair_id",
        format_prompt(F.col("prompt")).alias("prompt_text"),
        format_response(F.col("chosen")).alias("response_text"),
    )


def encode_examples(
    examples: DataFrame, vocabulary: DataFrame, max_length: int = D.MAX_LENGTH
) -> DataFrame:
    """Truncated prompt and response ids per pair."""
    coded = encode_tokens(
        format_examples(examples),
        {"prompt_text": "prompt_ids", "response_text": "response_ids"},
        vocabulary,
        "pair_id",
    )
    prompt, response = truncate_for_sft(F.col("prompt_ids"), F.col("response_ids"), max_length)
    return coded.select("pair_id", prompt.alias("prompt_ids"), response.alias("response_ids"))


def label_examples(encoded: DataFrame) -> DataFrame:
    """Input ids and labels, with the prompt ignored by the loss."""
    ids, labels = mask_prompt(F.col("prompt_ids"), F.col("response_ids"))
    return encoded.select("pair_id", ids.alias("input_ids"), labels.alias("labels"))


def padded_batches(labelled: DataFrame, batch_size: int = D.BATCH_SIZE) -> DataFrame:
    """Batches in key order, padded to the widest row of each batch.

    Batch number and width need only the key and the length of a row, so the arrays
    themselves are moved once, by the join at the end. The rows are stored first: texts
    are read and coded once, although lengths and arrays are used at different points.
    A stored row has a number of its own, so equal or null keys neither multiply nor lose rows.
    """
    numbered = labelled.withColumn("_row", F.monotonically_increasing_id())
    rows = durable(numbered.withColumn("length", F.size("input_ids")))
    batches = assign_batches(rows.select("pair_id", "_row", "length"), ["pair_id", "_row"], batch_size)
    width = F.max("length").over(Window.partitionBy("batch_id"))
    batches = batches.withColumn("width", width).drop("length", "pair_id")
    return rows.join(batches, "_row").select(
        "batch_id",
        "ordinal",
        "pair_id",
        "width",
        pad_right(F.col("input_ids"), F.col("width"), D.PAD_ID).alias("input_ids"),
        attention_mask(F.col("length"), F.col("width")).alias("attention_mask"),
        pad_right(F.col("labels"), F.col("width"), D.IGNORE_LABEL).alias("labels"),
    )


def response_cross_entropy(tokens: DataFrame, batch: str, label: str, log_prob: str) -> DataFrame:
    """Mean negative log-probability of the supervised targets, per batch.

    Each row is one target token with its own log-probability. A batch without any
    supervised target has a NaN loss.
    """
    supervised = F.col(label) != D.IGNORE_LABEL
    count = F.count_if(supervised)
    loss = -F.avg(F.when(supervised, F.col(log_prob)))
    return tokens.groupBy(batch).agg(
        count.alias("n_supervised"), F.coalesce(loss, F.lit(float("nan"))).alias("loss")
    )
