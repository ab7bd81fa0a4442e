"""Element-wise sums and means of ``ARRAY`` vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark import defaults as D


def _vector_sum(vector: Column) -> Column:
    """Sum of vectors, partially aggregated: a task sends one vector per group."""
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def masked_mean_pool(df: DataFrame, group: str, vector: str, mask: str) -> DataFrame:
    """Mean of the vectors with a true mask, per group; zeros where all are masked."""
    kept = F.transform(
        F.col(vector).cast("array<double>"), lambda x: F.when(F.col(mask), x).otherwise(F.lit(0.0))
    )
    count = F.count_if(F.col(mask))
    return (
        df.groupBy(group)
        .agg(_vector_sum(kept).alias("_sum"), count.alias("n_vectors"))
        .select(
            group,
            "n_vectors",
            F.transform(
                "_sum", lambda x: x / F.greatest(F.col("n_vectors"), F.lit(D.MASK_EPSILON))
            ).alias("pooled"),
        )
    )


def mean_fill_vectors(df: DataFrame, vector: str, name: str = "filled") -> DataFrame:
    """Add ``name``: the vector, or the mean of all known vectors where it is null."""
    known = df.where(F.col(vector).isNotNull())
    values = F.col(vector).cast("array<double>")
    mean = (
        known.agg(_vector_sum(values).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .select(F.when(F.col("_n") > 0, F.transform("_sum", lambda x: x / F.col("_n"))))
        .scalar()
    )
    return df.withColumn("_mean", mean).withColumn(name, F.coalesce(values, "_mean")).drop("_mean")
