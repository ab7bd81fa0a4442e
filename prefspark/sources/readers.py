"""Read preference tables and prompt sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark import defaults as D
from prefspark.operators.preferences import first_rows


def read_preferences(
    spark: SparkSession, path: str, key: str | None = None, limit: int | None = None
) -> DataFrame:
    """Prompt, chosen and rejected of a Parquet table, with its key as ``pair_id`` if it has one.

    A limit needs the key: the first rows of a table are defined only in some order.
    """
    columns = ["prompt", "chosen", "rejected"]
    if key is None:
        if limit is not None:
            raise ValueError("a limit needs a key column to order by")
        return spark.read.parquet(path).select(*columns)
    return first_rows(spark.read.parquet(path).select(F.col(key).alias("pair_id"), *columns), "pair_id", limit)


def evaluation_prompts(
    sheet: DataFrame,
    key: str = "prompt_id",
    column: str = D.PROMPT_COLUMN,
    limit: int | None = None,
) -> DataFrame:
    """Prompts of one column as text, missing ones left out before the limit counts."""
    known = F.col(column).isNotNull()
    if isinstance(sheet.schema[column].dataType, (T.FloatType, T.DoubleType)):
        known = known & ~F.isnan(column)
    prompts = sheet.where(known).select(
        F.col(key).alias("prompt_id"), F.col(column).cast("string").alias("prompt")
    )
    return first_rows(prompts, "prompt_id", limit)


def read_prompts(
    spark: SparkSession,
    path: str,
    key: str = "prompt_id",
    column: str = D.PROMPT_COLUMN,
    limit: int | None = None,
    *,
    csv: bool | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Prompts from a Parquet table or from CSV with a header.

    ``csv`` says which; by default the ending of the path does. Prompts with line breaks need
    ``multi_line``, and then a file is read by one task.
    """
    if path.rstrip("/").endswith(".csv") if csv is None else csv:
        sheet = spark.read.csv(path, header=True, multiLine=multi_line, escape='"').withColumn(
            key, F.col(key).cast("bigint")
        )
    else:
        sheet = spark.read.parquet(path)
    return evaluation_prompts(sheet, key, column, limit)
