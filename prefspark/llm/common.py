"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.storage import durable

#: Rows that are turned into Python objects at a time, so that long texts don't pile up.
ROWS_AT_ONCE = 64
#: Bytes of text that steps on whole columns take at a time; a longer text is taken alone.
BYTES_AT_ONCE = 1 << 20


def ship_library(spark: SparkSession) -> None:
    """Let Python tasks import this library, once per context."""
    context = spark.sparkContext
    if getattr(context, "_prefspark_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="prefspark-code-")) / "prefspark.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for file in sorted(package.rglob("*.py")):
            bundle.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._prefspark_shipped = True


def map_batches(df: DataFrame, function: Callable, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow`` on executors that have the library."""
    ship_library(df.sparkSession)
    return df.mapInArrow(function, schema)


def documents_of(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: whatever else a table holds can't clash with ours."""
    return docs.select(*(docs[c] for c in columns))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized_slices(batches: Iterator[pa.RecordBatch], column: int, size: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """All rows in order, as many at a time as have ``size`` bytes in a text column, at least one."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def first_row_id() -> int:
    """Where the row numbers of the running task start.

    They are unique within one run of a job. Store the result before it is used twice.
    """
    return TaskContext.get().partitionId() << 33


def arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.DoubleType(): pa.float64(),
        T.StringType(): pa.string(),
        T.BinaryType(): pa.binary(),
        T.BooleanType(): pa.bool_(),
    }

    def kind(t: T.DataType) -> pa.DataType:
        if isinstance(t, T.ArrayType):
            return pa.list_(kind(t.elementType))
        if isinstance(t, T.StructType):
            return pa.struct([(f.name, kind(f.dataType)) for f in t.fields])
        return kinds[t]

    return pa.schema([(f.name, kind(f.dataType)) for f in schema.fields])


#: Bytes, by the number of rows and their width, up to which a table is sent to every executor.
SENT_BYTES = 16 << 20


def sent_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, marked for a broadcast if its counted rows are few; else left to a shuffle."""
    return F.broadcast(df) if df.limit(SENT_BYTES // row_bytes + 1).count() * row_bytes <= SENT_BYTES else df


#: Column that carries row numbers through operators.
ROW = "_prefspark_row"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored once, with a number in ``ROW`` that no other row has."""
    return durable(docs.withColumn(ROW, F.monotonically_increasing_id()))


def without(docs: DataFrame, rejected: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose key is among ``rejected``.

    A null key is a key like any other, and rows that share a key share its fate: to decide
    row by row, use a key that is unique, as :func:`numbered` gives.
    """
    gone = sent_if_small(durable(rejected.select(F.col(key).alias("_gone")).distinct()), 16)
    return docs.join(gone, docs[key].eqNullSafe(gone["_gone"]), "left_anti")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]
