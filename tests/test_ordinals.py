from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from prefspark.operators.conversations import assemble_conversations, final_responses
from prefspark.operators.ordinals import assign_batches, dense_ordinal, ordinal_within


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_dense_ordinal(spark, partitions):
    keys = random.Random(0).sample(range(-10_000, 10_000), 3_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        frame = spark.createDataFrame([(k,) for k in keys], "k int").repartition(partitions)
        got = {r["k"]: r["n"] for r in dense_ordinal(frame, ["k"], "n", 100).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {k: i for i, k in enumerate(sorted(keys), start=1)}


def test_dense_ordinal_with_ties_in_the_first_column(spark):
    """A third of the rows share the first order column."""
    rows = [(0 if i % 3 else i, f"{i:05d}") for i in range(2_000)]
    frame = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = dense_ordinal(frame, ["a", "b"], "n", 50).orderBy("n").collect()
    assert [(r["a"], r["b"]) for r in got] == sorted(rows)
    assert [r["n"] for r in got] == list(range(1, 2_001))


def test_dense_ordinal_with_any_text_as_key(spark):
    keys = sorted({chr(97 + i % 26) * (i % 5) + '"\\' * (i % 3) + chr(0x1F600 + i) for i in range(400)})
    keys += ["", "é", "\n", "\u2028x"]
    frame = spark.createDataFrame([(k,) for k in keys], "k string").repartition(3)
    got = dense_ordinal(frame, ["k"], "n", 20).orderBy("n").collect()
    assert [r["k"] for r in got] == sorted(keys, key=lambda k: k.encode())
    assert [r["n"] for r in got] == list(range(1, len(keys) + 1))


def test_dense_ordinal_by_time(spark):
    frame = spark.range(500).withColumn("t", F.timestamp_micros((F.col("id") * 7919) % 500 * 1_000_003))
    got = dense_ordinal(frame, ["t"], "n", 40).orderBy("n").collect()
    assert [r["t"] for r in got] == sorted(r["t"] for r in got) and len(got) == 500
    assert [r["n"] for r in got] == list(range(1, 501))


def test_empty_and_tiny_tables(spark):
    assert dense_ordinal(spark.range(0), ["id"]).count() == 0
    assert [tuple(r) for r in dense_ordinal(spark.range(1), ["id"]).collect()] == [(0, 1)]


def test_floating_keys_are_refused(spark):
    with pytest.raises(TypeError):
        dense_ordinal(spark.range(3).selectExpr("CAST(id AS DOUBLE) AS x"), ["x"])


@pytest.mark.parametrize("limit", [100, 1_000_000], ids=["hot groups split", "plain window"])
def test_ordinal_within_groups(spark, limit):
    rng = random.Random(2)
    groups = [None if i % 3 == 0 else 0 if i % 3 == 1 else rng.randrange(1, 60) for i in range(3_000)]
    rows = [(g, rng.randrange(10_000), i) for i, g in enumerate(groups)]
    frame = spark.createDataFrame(rows, "g int, t int, id int").repartition(6)
    got = ordinal_within(frame, ["g"], ["t", "id"], "n", limit).collect()
    seen = {}
    want = {}
    for g, _, i in sorted(rows, key=lambda r: r[1:]):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert {r["id"]: r["n"] for r in got} == want
    assert len(got) == len(rows)


def test_batches(spark):
    got = assign_batches(spark.range(5), ["id"], 2).orderBy("id").collect()
    assert [r["batch_id"] for r in got] == [0, 0, 1, 1, 2]
    assert {r["batch_id"] for r in assign_batches(spark.range(5), ["id"], 99).collect()} == {0}
    with pytest.raises(ValueError):
        assign_batches(spark.range(5), ["id"], 0)


def test_a_long_chat_is_folded_in_parts(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(50)]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "u")]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(4)
    parts = assemble_conversations(frame, 16).orderBy("conv_id", "part").collect()
    assert [(r["conv_id"], r["part"], len(r["messages"])) for r in parts] == [
        (1, 0, 16), (1, 1, 16), (1, 2, 16), (1, 3, 2), (2, 0, 2),
    ]
    assert [m["content"] for r in parts[:4] for m in r["messages"]] == [f"t{t}" for t in range(50)]
    answers = {r["conv_id"]: r["response"] for r in final_responses(frame).collect()}
    assert answers == {1: "t49", 2: "u"}


def test_local_times_keep_their_order_across_clock_changes(spark):
    import datetime as dt

    from prefspark.operators.ordinals import _key

    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # 02:30 on 2024-03-31 doesn't exist in Berlin; 02:30 on 2024-10-27 exists twice.
        times = [dt.datetime(2024, 3, 31, h, m) for h, m in ((1, 59), (2, 0), (2, 30), (3, 0))]
        times += [dt.datetime(2024, 10, 27, h, m) for h, m in ((1, 59), (2, 30), (2, 59), (3, 0))]
        df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
        key, _ = _key(df, ["t"])
        got = [r[0] for r in df.select(key["k0"]).collect()]
        assert got == sorted(got) and len(set(got)) == len(got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
