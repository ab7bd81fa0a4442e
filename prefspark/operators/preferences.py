"""Preference rows: final responses, and rows that have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.functions.messages import final_response, response_problem


def _with_reason(df: DataFrame) -> DataFrame:
    chosen, rejected = df.schema["chosen"].dataType, df.schema["rejected"].dataType
    return df.withColumn(
        "reason",
        F.coalesce(
            F.when(F.col("prompt").isNull(), F.lit("null_prompt")),
            response_problem(F.col("chosen"), chosen),
            response_problem(F.col("rejected"), rejected),
        ),
    )


def preference_examples(df: DataFrame, *, strict: bool = False) -> DataFrame:
    """Map prompt, chosen and rejected to text; other columns stay.

    Rows without a prompt or a response are left to ``invalid_preferences``, or end the
    job when ``strict``.
    """
    chosen, rejected = df.schema["chosen"].dataType, df.schema["rejected"].dataType
    checked = _with_reason(df)
    if strict:
        failure = F.raise_error(
            F.concat(F.lit("preference row is not usable: "), F.col("reason"))
        ).cast("string")

        # The check guards every column that is read, so that pruning cannot drop it.
        def guarded(value: Column) -> Column:
            return F.when(F.col("reason").isNull(), value).otherwise(failure)

    else:
        checked = checked.where(F.col("reason").isNull())

        def guarded(value: Column) -> Column:
            return value

    return checked.withColumns(
        {
            "prompt": guarded(F.col("prompt").cast("string")),
            "chosen": guarded(final_response(F.col("chosen"), chosen)),
            "rejected": guarded(final_response(F.col("rejected"), rejected)),
        }
    ).drop("reason")


def invalid_preferences(df: DataFrame) -> DataFrame:
    """Rows that ``preference_examples`` leaves out, with the first reason found."""
    return _with_reason(df).where(F.col("reason").isNotNull())


def first_rows(df: DataFrame, order_by: str, limit: int | None) -> DataFrame:
    """First ``limit`` rows in a stated order; all rows for None."""
    return df if limit is None else df.orderBy(order_by).limit(limit)
