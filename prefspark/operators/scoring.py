"""Apply a caller's scorer or judge to batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _apply(
    df: DataFrame,
    make: Callable[[], Callable[..., Sequence[Any]]],
    keys: Sequence[str],
    inputs: Sequence[str],
    name: str,
    kind: T.DataType,
    convert: Callable[[Any], Any],
) -> DataFrame:
    """Keys and one converted result per row; null for rows whose call fails.

    ``make`` runs once per task, so a model is loaded once and never sent with the rows.
    The callable gets one pandas column per input and returns as many results. If it
    raises TypeError or ValueError, the batch is halved until the failing rows are alone, and
    only those get null. A result that can't be converted is null without another call.
    """
    keys, inputs = list(keys), list(inputs)
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(name, kind, True)])
    dtype = "float64" if isinstance(kind, T.DoubleType) else object

    def run(batches):
        call = make()

        def converted(value):
            try:
                return convert(value)
            except (TypeError, ValueError):
                return None

        def results_of(columns, first, last):
            try:
                return [converted(r) for r in call(*(c.iloc[first:last] for c in columns))]
            except (TypeError, ValueError):
                if last - first <= 1:
                    return [None] * (last - first)
                middle = (first + last) // 2
                return results_of(columns, first, middle) + results_of(columns, middle, last)

        for frame in batches:
            columns = [frame[c] for c in inputs]
            results = results_of(columns, 0, len(frame))
            done = frame[keys].copy()
            done[name] = results
            done[name] = done[name].astype(dtype)
            yield done

    needed = list(dict.fromkeys(keys + inputs))
    return df.select(*needed).mapInPandas(run, schema)


def batch_score(
    df: DataFrame,
    make_scorer: Callable[[], Callable[..., Sequence[Any]]],
    keys: Sequence[str],
    inputs: Sequence[str],
    name: str = "score",
) -> DataFrame:
    """Keys and a ``DOUBLE`` per row from a scorer of pandas columns."""
    return _apply(df, make_scorer, keys, inputs, name, T.DoubleType(), float)


def batch_verdicts(
    df: DataFrame,
    make_judge: Callable[[], Callable[..., Sequence[Any]]],
    key: str = "prompt_id",
    inputs: Sequence[str] = ("prompt", "sft_answer", "ppo_answer"),
    name: str = "verdict_raw",
) -> DataFrame:
    """Key and the judge's reply as text, to be parsed like replies read from a table."""
    return _apply(df, make_judge, [key], inputs, name, T.StringType(), str)
