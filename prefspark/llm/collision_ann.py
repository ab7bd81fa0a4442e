"""Approximate nearest neighbours by inner product: collision counting over sorted projections.

Method (query-aware collision counting with virtual rehashing):

1. Only valid vectors take part: not null, no null or non-finite component, not all zero.
   Vectors of different lengths are compared as if the shorter were padded with zeros.
2. Largest inner product becomes smallest distance: a data vector ``x`` gets one more
   component ``sqrt(M*M - |x|^2)`` (``M``: the largest norm, one Spark aggregate), a query
   ``q`` gets 0. Then ``|q' - x'|^2 = |q|^2 + M^2 - 2 q.x``.
3. Index: valid rows are dealt to shards of at most ``shard_rows`` rows by a hash of a row
   number, so a repeated or hot ``vec_id`` spreads like any other. Per shard and per seeded
   Gaussian projection ``j`` the projection values are kept sorted: one single-projection
   sorted array each.
4. Search: queries (``vec_id % 20 == 0``) in blocks of ``query_block`` rows meet every shard,
   one task per (shard, block). Around a query's own projection value each sorted array gets
   a window of half-width ``w * R / 2``; virtual rehashing widens ``R`` by ``c`` each round.
   Every array whose window holds a vector is one collision; at ``threshold`` collisions the
   vector becomes a candidate and is verified by its inner product in double precision
   (summed row by row for those returned, so that equal vectors tie). The search of a query in a shard stops once
   ``k`` verified candidates lie within distance ``R`` (every vector that close collides in a
   share ``p1 = P(|Z| <= w/2)`` of arrays on average, and so has passed the threshold with high
   probability), or when the windows hold the whole shard: then every vector is verified.
5. Merge: each shard gives its best ``k`` per query; of these, the first ``k`` by score
   descending, then ``vec_id``, then row number, are the answer.

Defined cases: no valid vectors or no queries give no rows; a query with fewer than ``k``
valid partners gets all of them; rows repeated with the same ``vec_id`` are distinct rows
(a repeated query row gets a list of its own, told apart by ``query_row``, and its copies are
candidates of each other); any other columns of the table are ignored, whatever their names.
Recall is measured against brute force in the tests (at least 0.9; see README for figures).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import ship_library
from prefspark.storage import durable

#: Fixed parameters of the search. Projections, window width, growth of the radius and the
#: collision threshold (share of projections) follow the usual choice for c = 2.
PROJECTIONS = 32
WIDTH = 2.719
GROWTH = 2.0
THRESHOLD_SHARE = 0.6
SEED = 20240611
#: Largest shard and query block: bound the memory of one task.
SHARD_ROWS = 16384
QUERY_BLOCK = 1024
#: Queries of a block that are searched together: bounds the matrix of their inner products.
QUERIES_AT_ONCE = 64

RESULT = T.StructType(
    [
        T.StructField("query_row", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def projections(dimension: int, count: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """Seeded Gaussian directions over the padded vector and its extra component."""
    return np.random.default_rng(seed).standard_normal((count, dimension + 1))


def _matrix(vectors: pd.Series, dimension: int) -> np.ndarray:
    out = np.zeros((len(vectors), dimension), dtype=np.float64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.asarray(v, dtype=np.float64)
    return out


def search_shard(
    data: np.ndarray,
    rows: np.ndarray,
    queries: np.ndarray,
    query_rows: np.ndarray,
    top: float,
    k: int,
    directions: np.ndarray,
    threshold: int,
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: (query number, shard positions, scores) of the best ``k`` found in one shard.

    ``top`` is the largest norm of all data; ``directions`` the projections.
    """
    n = len(data)
    if n == 0 or len(queries) == 0:
        return []
    extra = np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", data, data), 0.0))
    values = data @ directions[:, :-1].T + np.outer(extra, directions[:, -1])  # (n, m)
    order = np.argsort(values, axis=0, kind="stable").T  # (m, n): a sorted array per projection
    ordered = np.take_along_axis(values.T, order, axis=1)
    m = directions.shape[0]
    # The place of every vector in every sorted array: it lies in a window if lo <= place < hi.
    places = np.empty((m, n), dtype=np.uint16 if n < 1 << 16 else np.uint32)
    np.put_along_axis(places, order, np.arange(n, dtype=places.dtype)[None, :], axis=1)
    shifted, inside = np.empty_like(places), np.empty((m, n), dtype=bool)
    counted = np.uint8 if m < 256 else np.uint32
    by_row = {int(r): i for i, r in enumerate(rows)}
    out = []
    for first in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[first : first + QUERIES_AT_ONCE]
        at = some @ directions[:, :-1].T  # a query's extra component is 0
        qq = np.einsum("ij,ij->i", some, some)
        # Inner products of the whole block at once; only those of candidates are used.
        products = some @ data.T
        radius = np.maximum(top - np.sqrt(qq), top / 256.0)
        active = np.arange(len(some))
        while len(active):
            half = WIDTH * radius[active] / 2
            lo = np.stack([np.searchsorted(ordered[j], at[active, j] - half, "left") for j in range(m)], axis=1)
            hi = np.stack([np.searchsorted(ordered[j], at[active, j] + half, "right") for j in range(m)], axis=1)
            held = (hi - lo).sum(axis=1)
            going = []
            for i, l, h, total in zip(active, lo, hi, held):
                whole = total == m * n
                if not whole and total < k * threshold:  # too few collisions for k candidates
                    going.append(i)
                    continue
                if whole:
                    found = np.ones(n, dtype=bool)
                elif total < n:
                    hits = np.concatenate([order[j, l[j] : h[j]] for j in range(m)])
                    found = np.bincount(hits, minlength=n) >= threshold
                else:
                    # Places below ``lo`` wrap around to large numbers, so one comparison does.
                    width = np.minimum(h - l, np.iinfo(places.dtype).max).astype(places.dtype)
                    np.subtract(places, l.astype(places.dtype)[:, None], out=shifted)
                    np.less(shifted, width[:, None], out=inside)
                    found = np.add.reduce(inside.view(np.uint8), axis=0, dtype=counted) >= threshold
                own = by_row.get(int(query_rows[first + i]))
                if own is not None:  # the query's own row takes no part
                    found[own] = False
                pos = np.flatnonzero(found)
                near = products[i, pos]
                if not whole and np.count_nonzero(qq[i] + top * top - 2 * near <= radius[i] * radius[i]) < k:
                    going.append(i)
                    continue
                if len(pos) > k:
                    # All that may tie with the k-th stay: the caller breaks ties by id.
                    slack = 1e-14 * max(data.shape[1], 16) * top * math.sqrt(qq[i])
                    pos = pos[near >= np.partition(near, -k)[-k] - slack]
                if len(pos):
                    # Row by row, so that equal vectors get equal scores wherever they lie; a
                    # matrix product rounds them apart and would decide ties.
                    out.append((first + i, pos, (data[pos] * some[i]).sum(axis=1)))
            active = np.array(going, dtype=np.int64)
            radius[active] *= GROWTH
    return out


def _searcher(k: int, dimension: int, top: float, directions: np.ndarray, threshold: int):
    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if len(data) == 0 or len(queries) == 0:
            return pd.DataFrame({f.name: [] for f in RESULT.fields})
        matrix = _matrix(data["vector"], dimension)
        rows = data["row"].to_numpy(np.int64)
        ids = data["vec_id"].to_numpy(np.int64)
        q_rows = queries["row"].to_numpy(np.int64)
        q_ids = queries["vec_id"].to_numpy(np.int64)
        parts = []
        for qi, pos, scores in search_shard(matrix, rows, _matrix(queries["vector"], dimension), q_rows, top, k, directions, threshold):
            # Best k by (score desc, vec_id, row) among the candidates kept above.
            key = np.lexsort((rows[pos], ids[pos], -scores))[:k]
            parts.append(pd.DataFrame({"query_row": q_rows[qi], "query_id": q_ids[qi], "vec_id": ids[pos][key], "row": rows[pos][key], "score": scores[key]}))
        if not parts:
            return pd.DataFrame({f.name: [] for f in RESULT.fields})
        return pd.concat(parts, ignore_index=True)

    return search


def valid_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows with a vector that takes part, stored once with a row number of their own."""
    v = vectors.select(vectors["vec_id"].alias("vec_id"), vectors[column].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists("vector", lambda x: x != 0)
    kept = v.where(F.col("vector").isNotNull() & finite & nonzero)
    return durable(kept.withColumn("row", F.monotonically_increasing_id()))


def nearest_neighbours(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
    projection_count: int = PROJECTIONS,
) -> DataFrame:
    """The ``k`` largest inner products of every query row (``vec_id % every == 0``) among all other rows.

    ``vectors`` needs ``vec_id`` and ``embedding``. Result: query_row, query_id, rank (from 1),
    vec_id, row, score; nearest first, ties to smaller ``vec_id``, then row number.
    """
    spark = vectors.sparkSession
    valid = valid_vectors(vectors)
    stats = valid.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))).alias("top"),
        F.max(F.size("vector")).alias("dimension"),
        F.sum((F.pmod("vec_id", F.lit(every)) == 0).cast("long")).alias("n_queries"),
    ).first()
    empty = spark.createDataFrame([], RESULT).withColumn("rank", F.lit(1)).select("query_row", "query_id", "rank", "vec_id", "row", "score")
    if not stats["n"] or not stats["n_queries"]:
        return empty
    shards = max(1, math.ceil(stats["n"] / shard_rows))
    blocks = max(1, math.ceil(stats["n_queries"] / query_block))
    directions = projections(stats["dimension"], projection_count)
    threshold = math.ceil(THRESHOLD_SHARE * projection_count)
    # Keys of a cogroup must have one type on both sides: equal ints and longs hash to different partitions.
    data = valid.select(
        "vec_id", "vector", "row",
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    queries = valid.where(F.pmod("vec_id", F.lit(every)) == 0).select(
        "vec_id", "vector", "row",
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
    )
    ship_library(spark)
    found = (
        data.groupBy("shard", "block")
        .cogroup(queries.groupBy("shard", "block"))
        .applyInPandas(_searcher(k, stats["dimension"], float(stats["top"]), directions, threshold), RESULT)
    )
    from pyspark.sql import Window

    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_row", "query_id", "rank", "vec_id", "row", "score")
