"""Write what trainers, judges and readers of results take from here."""

from __future__ import annotations

from pyspark.sql import DataFrame

from prefspark.operators.evaluation import evaluation_summary, ordered_errors
from prefspark.storage import durable


def write_padded_batches(batches: DataFrame, path: str) -> None:
    """Parquet with the rows of each file in batch order and every batch in one file."""
    batches.repartitionByRange("batch_id").sortWithinPartitions("batch_id", "pair_id").write.mode(
        "overwrite"
    ).parquet(path)


def write_judge_requests(requests: DataFrame, path: str) -> None:
    """JSON lines, one request each, for a judge that runs elsewhere."""
    requests.write.mode("overwrite").json(path)


def write_evaluation(judgements: DataFrame, path: str) -> None:
    """One JSON record with the counts and metrics, and the ordered errors as JSON lines.

    The error list has a line per prompt rather than one array, so that it can be of any
    length.
    """
    columns = ["prompt_id", "verdict", "judge_score", "reward"]
    judgements = durable(judgements.select(*columns))
    evaluation_summary(judgements).write.mode("overwrite").json(f"{path}/summary")
    errors = ordered_errors(judgements)
    errors.repartitionByRange("sample").sortWithinPartitions("sample").write.mode(
        "overwrite"
    ).json(f"{path}/errors")
