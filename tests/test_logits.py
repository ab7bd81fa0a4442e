from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.functions import logits as L
from prefspark.functions.losses import linear_score


def doubles(values):
    return F.lit([float(v) for v in values]).cast("array<double>")


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(11)
    rows = [(g, [rng.choice([-1.5, 0.0, 0.5, 2.0, 800.0, rng.uniform(-3, 3)]) for _ in range(20)]) for g in range(60)]
    return rows, spark.createDataFrame(rows, "g int, x array<double>").repartition(4)


def softmax(x):
    e = np.exp(np.array(x) - np.max(x))
    return e / e.sum()


def test_log_softmax_does_not_overflow(table):
    rows, frame = table
    got = {r["g"]: r for r in frame.select("g", L.log_softmax(F.col("x")).alias("a"), L.target_log_prob(F.col("x"), F.lit(3)).alias("t")).collect()}
    for g, x in rows:
        shifted = np.array(x) - max(x)
        want = shifted - math.log(np.exp(shifted).sum())
        assert got[g]["a"] == pytest.approx(list(want), abs=1e-9)
        assert got[g]["t"] == pytest.approx(want[3], abs=1e-9)


@pytest.mark.parametrize("k", [1, 5, 20, 99])
def test_top_k_keeps_ties(table, k):
    rows, frame = table
    got = {r["g"]: r for r in frame.select("g", L.top_k_logits(F.col("x"), k).alias("kept"), L.top_k_softmax(F.col("x"), 0.8, k).alias("p")).collect()}
    for g, x in rows:
        bar = sorted(x, reverse=True)[min(k, len(x)) - 1]
        assert got[g]["kept"] == [v if v >= bar else None for v in x]
        scaled = np.where(np.array(x) >= bar, np.array(x) / 0.8, -np.inf)
        assert got[g]["p"] == pytest.approx(list(softmax(scaled)), abs=1e-9)


def test_arguments():
    for temperature, k in [(0, 5), (-1, 5), (0.8, 0)]:
        with pytest.raises(ValueError):
            L.check_sampling(temperature, k)


def test_greedy_takes_the_lowest_index_on_a_tie(one_row):
    assert one_row(L.greedy_index(doubles([1, 3, 3, 2]))) == (1,)


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_sampling_repeats_for_any_partitioning(spark, table, partitions):
    _, frame = table
    drawn = L.sample_index(L.top_k_softmax(F.col("x"), 0.8, 5), F.col("g"))
    first = frame.select("g", drawn.alias("i")).orderBy("g").collect()
    again = frame.repartition(partitions).select("g", drawn.alias("i")).orderBy("g").collect()
    assert first == again


def test_sampling_follows_the_probabilities(spark):
    frame = spark.range(20_000).select("id", L.sample_index(doubles([0.5, 0.0, 0.3, 0.2]), F.col("id")).alias("i"))
    counts = {r["i"]: r["count"] / 20_000 for r in frame.groupBy("i").count().collect()}
    assert set(counts) == {0, 2, 3}
    for index, p in [(0, 0.5), (2, 0.3), (3, 0.2)]:
        assert counts[index] == pytest.approx(p, abs=0.015)


def test_linear_score(one_row):
    assert one_row(linear_score(doubles([1, 2, 3]), [0.5, -1, 2], 0.25))[0] == pytest.approx(4.75)
    assert one_row(linear_score(doubles([1, 2]), [1, 1, 1])) == (None,)
