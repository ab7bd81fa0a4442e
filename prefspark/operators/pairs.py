"""Scores and losses of chosen/rejected pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.losses import margin_hinge
from prefspark.functions.tokens import attention_mask, pad_right, truncate_pair
from prefspark.operators.ordinals import assign_batches
from prefspark.storage import durable


def pair_scores(scores: DataFrame) -> DataFrame:
    """Long ``(pair_id, side, score)`` rows as one row per pair."""
    return scores.groupBy("pair_id").pivot("side", ["chosen", "rejected"]).agg(F.max("score"))


def margin_losses(pairs: DataFrame, margin: float = D.MARGIN) -> DataFrame:
    """Add the hinge loss of each pair."""
    return pairs.withColumn(
        "loss", margin_hinge(F.col("chosen"), F.col("rejected"), margin)
    )


def margin_loss_by_batch(
    pairs: DataFrame, margin: float = D.MARGIN, batch_size: int = D.BATCH_SIZE
) -> DataFrame:
    """Mean hinge loss of each batch of pairs, batches taken in key order.

    Numbering reads its input several times, so the narrow loss rows are stored first.
    """
    losses = durable(margin_losses(pairs, margin).select("pair_id", "loss"))
    batches = assign_batches(losses, ["pair_id"], batch_size)
    return batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.avg("loss").alias("loss")
    )


def encode_pair_batches(
    pairs: DataFrame, max_length: int = D.MAX_LENGTH, batch_size: int = D.BATCH_SIZE
) -> DataFrame:
    """Truncate ``(prompt_ids, answer_ids)`` together and pad them to the widest of a batch.

    Row layout: cls, prompt, sep, sep, answer, sep. A stored row has a number of its own, so
    equal or null keys neither multiply nor lose rows.
    """
    prompt, answer = truncate_pair(F.col("prompt_ids"), F.col("answer_ids"), max_length)
    cut = pairs.select("pair_id", prompt.alias("prompt_ids"), answer.alias("answer_ids"))
    length = F.size("prompt_ids") + F.size("answer_ids") + F.lit(4)
    rows = durable(cut.withColumn("length", length).withColumn("_row", F.monotonically_increasing_id()))
    width = F.max("length").over(Window.partitionBy("batch_id"))
    batches = assign_batches(rows.select("pair_id", "_row", "length"), ["pair_id", "_row"], batch_size)
    batches = batches.withColumn("width", width).drop("length", "pair_id")
    cls, sep = F.lit(D.SPECIAL_TOKENS.index(D.CLS)), F.lit(D.SPECIAL_TOKENS.index(D.SEP))
    ids = F.concat(
        F.array(cls), "prompt_ids", F.array(sep, sep), "answer_ids", F.array(sep)
    )
    return rows.join(batches, "_row").select(
        "batch_id",
        "pair_id",
        F.size("prompt_ids").alias("prompt_length"),
        F.size("answer_ids").alias("answer_length"),
        "width",
        pad_right(ids, F.col("width"), D.PAD_ID).alias("input_ids"),
        attention_mask(F.col("length"), F.col("width")).alias("attention_mask"),
    )
