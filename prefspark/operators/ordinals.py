"""Dense row numbers and fixed-size batches without a single-partition sort.

``row_number() OVER (ORDER BY key)`` moves the whole table into one task. Here the key
range is cut into buckets at split points taken from a sample of the keys. The bucket of
a row is a pure function of its key, so every attempt of every task agrees on it. Rows
are numbered inside their bucket and moved up by the sizes of the buckets before it. The
sample decides only how even the buckets are, never which number a row gets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark import defaults as D
from prefspark.functions.binding import let
from prefspark.storage import durable

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 16_384
_SAMPLES_PER_BUCKET = 32


def _key(df: DataFrame, order_by: Sequence[str]) -> tuple[Column, T.StructType]:
    """Order columns as one comparable struct of JSON-safe values, and its type."""
    fields, types = [], []
    for i, name in enumerate(order_by):
        column, dtype = F.col(name), df.schema[name].dataType
        if isinstance(dtype, T.TimestampType):
            column, dtype = F.unix_micros(column), T.LongType()
        elif isinstance(dtype, T.TimestampNTZType):
            # Microseconds from the epoch, from the fields themselves: a cast through the session
            # zone (and timestampdiff, which takes it too) runs backwards where clocks go back.
            day = F.unix_date(column.cast("date")).cast("long") * 86_400_000_000
            time = F.hour(column).cast("long") * 3_600_000_000 + F.minute(column).cast("long") * 60_000_000
            second = (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("long")
            column, dtype = day + time + second, T.LongType()
        elif isinstance(dtype, T.DateType):
            column, dtype = F.unix_date(column), T.IntegerType()
        elif not isinstance(dtype, (T.IntegralType, T.StringType)):
            raise TypeError(f"order column {name} must be an integer, string, date or timestamp")
        fields.append(column.alias(f"k{i}"))
        types.append(T.StructField(f"k{i}", dtype))
    return F.struct(*fields), T.StructType(types)


def _split_points(df: DataFrame, key: Column, buckets: int, rows: int) -> list[dict]:
    """Up to ``buckets - 1`` ascending keys, evenly spaced in a sample of about ``buckets * 32`` keys.

    The sample is a hash-chosen share of the distinct keys (one in ``rows // wanted``), taken
    whole: a prefix of it would favour the first parts read.
    """
    wanted = buckets * _SAMPLES_PER_BUCKET
    step = max(1, rows // wanted)
    sample = (
        df.select(key.alias("key"))
        .where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0)
        .groupBy("key")
        .count()
        .orderBy("key")
        .select("key")
        .collect()
    )
    keys = [row["key"].asDict() for row in sample]
    return [keys[i * len(keys) // buckets] for i in range(1, buckets)] if keys else []


def _bucket(key: Column, key_type: T.StructType, splits: list[dict]) -> Column:
    """Number of split points at or below the key, by bisection."""
    if not splits:
        return F.lit(0)
    strides = [1 << b for b in reversed(range(len(splits).bit_length()))]
    points = F.from_json(F.lit(json.dumps(splits)), T.ArrayType(key_type))

    def advance(k: Column):
        def step(low: Column, stride: Column) -> Column:
            reached = F.get(points, low + stride - 1) <= k
            return F.when(F.coalesce(reached, F.lit(False)), low + stride).otherwise(low)

        return step

    number = let(
        key, lambda k: F.aggregate(F.lit(strides).cast("array<int>"), F.lit(0), advance(k))
    )
    # Never null: without the coalesce, joins on the bucket would test it row by row.
    return F.coalesce(number, F.lit(0))


def _bucket_count(df: DataFrame, rows: int, rows_per_bucket: int) -> int:
    parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BUCKETS, max(parallel, 2, -(-rows // rows_per_bucket)))


def dense_ordinal(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "ordinal",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add 1, 2, 3, ... in the order of ``order_by``, which must identify a row."""
    key, key_type = _key(df, order_by)
    rows = df.count()
    buckets = _bucket_count(df, rows, rows_per_bucket)
    placed = df.withColumn(
        "_bucket", _bucket(key, key_type, _split_points(df, key, buckets, rows))
    )
    # At most MAX_BUCKETS rows: fit for one task and for a broadcast.
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn(
            "_before",
            F.sum("_rows").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("_bucket", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by))
    return (
        placed.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (F.col("_inside") + F.col("_before")).cast("bigint"))
        .drop("_bucket", "_inside", "_before")
    )


def ordinal_within(
    df: DataFrame,
    within: Sequence[str],
    order_by: Sequence[str],
    name: str = "ordinal",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add 1, 2, 3, ... inside each group, also where one group is most of the table.

    Group sizes are measured first. Without a group above ``rows_per_bucket`` a plain
    window is safe. Otherwise the large groups, and only they, are cut into key buckets.
    """
    within = list(within)
    # As one struct a group key is never null, so that a null group can be joined, too.
    grouped = df.withColumn("_group", F.struct(*within))
    large = (
        grouped.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_size"))
        .where(F.col("_size") > rows_per_bucket)
    )
    large_rows = large.agg(F.sum("_size")).first()[0]
    if not large_rows:
        number = F.row_number().over(Window.partitionBy(*within).orderBy(*order_by))
        return df.withColumn(name, number.cast("bigint"))

    # There are fewer large groups than rows / rows_per_bucket: fit for a broadcast.
    marks = F.broadcast(durable(large.select("_group", F.lit(True).alias("_large"))))
    key, key_type = _key(df, order_by)
    buckets = _bucket_count(df, large_rows, rows_per_bucket)
    in_large = grouped.join(marks, "_group", "left_semi")
    bucket = _bucket(key, key_type, _split_points(in_large, key, buckets, large_rows))
    placed = grouped.join(marks, "_group", "left").withColumn(
        "_bucket", F.when(F.col("_large"), bucket).otherwise(F.lit(0))
    )
    before = Window.partitionBy("_group").orderBy("_bucket")
    offsets = (
        placed.where("_large")
        .groupBy("_group", "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, -1)))
        .drop("_rows")
    )
    inside = F.row_number().over(Window.partitionBy("_group", "_bucket").orderBy(*order_by))
    number = F.col("_inside") + F.coalesce(F.col("_before"), F.lit(0))
    return (
        placed.withColumn("_inside", inside)
        .join(offsets, ["_group", "_bucket"], "left")
        .withColumn(name, number.cast("bigint"))
        .drop("_group", "_bucket", "_large", "_inside", "_before")
    )


def assign_batches(
    df: DataFrame,
    order_by: Sequence[str],
    batch_size: int = D.BATCH_SIZE,
    name: str = "batch_id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Number batches of ``batch_size`` rows in order; the last one may be smaller."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    numbered = dense_ordinal(df, order_by, "ordinal", rows_per_bucket)
    return numbered.withColumn(name, F.expr(f"(ordinal - 1) div {int(batch_size)}"))
