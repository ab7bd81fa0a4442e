"""Train/test deduplication against a plain comparison of every train and test row."""

from __future__ import annotations

import random
import re
from pathlib import Path

from prefspark.operators import dedup as U

SCHEMA = "doc_id long, text string, norm string, key string, s string"


def norm(text):
    return re.sub(r"\s+", " ", (text or "").strip()).lower() if text else ""


def shingle_set(text, size=5):
    w = [x for x in norm(text).split(" ") if x]
    if not w:
        return set()
    return {" ".join(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))}


def plain(train, test, pct=80):
    out = []
    for doc_id, text in test:
        exact = [tid for tid, t in train if norm(t) == norm(text)]
        b = shingle_set(text)
        near = [tid for tid, t in train if b and (a := shingle_set(t)) and 100 * len(a & b) >= pct * len(a | b)]
        ids = [i for i in exact + near if i is not None]
        out.append((doc_id, len(exact), len(near), min(ids) if ids else None, bool(exact or near)))
    return sorted(out, key=repr)


def run(spark, train, test):
    frame = lambda rows: spark.createDataFrame([(*r, "n", "k", "s") for r in rows], SCHEMA)
    got = U.prompt_dedup(frame(train), frame(test)).collect()
    return sorted((tuple(r) for r in got), key=repr)


def test_against_all_pairs(spark):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(40)]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 60))) for _ in range(25)]

    def variant(t):
        w = t.split(" ")
        if len(w) > 10 and rnd.random() < 0.6:
            w[rnd.randrange(len(w))] = "zz"
        return rnd.choice(["", " ", "\t"]) + " ".join(w).upper() * rnd.choice([1, 1, 1]) + rnd.choice(["", "\n"])

    train = [(i, variant(rnd.choice(base))) for i in range(120)] + [(None, base[0]), (500, None), (501, "")]
    test = [(1000 + i, variant(rnd.choice(base))) for i in range(60)] + [(None, base[1]), (2000, None), (2001, "  "), (1000, base[2])]
    want = plain(train, test)
    assert any(r[2] > r[1] for r in want) and any(r[1] for r in want)
    assert run(spark, train, test) == want


def test_long_texts_empty_sides(spark):
    long_text = " ".join(f"t{i}" for i in range(30000))
    train = [(1, long_text), (2, long_text + " extra"), (3, "a b c")]
    test = [(9, long_text.replace("t7 ", "x7 ")), (10, "a b c")]
    assert run(spark, train, test) == plain(train, test)
    assert run(spark, [], test) == sorted([(9, 0, 0, None, False), (10, 0, 0, None, False)], key=repr)
    assert run(spark, train, []) == []


def test_order_of_prefixes_does_not_change_the_result(spark, monkeypatch):
    # A line shared by all texts is counted in a share of them, and goes last in the prefixes.
    line = "one line that all of the texts hold at their end"
    rnd = random.Random(8)
    base = [" ".join(rnd.choice("abcdefgh") for _ in range(40)) for _ in range(6)]
    train = [(i, f"{rnd.choice(base)} {rnd.choice(['x', 'y'])} {line}") for i in range(50)]
    test = [(100 + i, f"{rnd.choice(base)} {rnd.choice(['x', 'z'])} {line}") for i in range(20)]
    want = plain(train, test)
    assert any(r[2] > r[1] for r in want)
    for texts, shingles, least in ((5, 100, 1), (10, 3, 2), (1, 1, 99)):
        monkeypatch.setattr(U, "ORDER_TEXTS", texts)
        monkeypatch.setattr(U, "ORDER_SHINGLES", shingles)
        monkeypatch.setattr(U, "ORDER_LEAST", least)
        assert run(spark, train, test) == want


def test_homes_and_rows_cut_in_any_way(spark, monkeypatch):
    rnd = random.Random(5)
    base = [" ".join(rnd.choice("abcdefghijk") for _ in range(120)) for _ in range(3)]

    def variant():
        w = rnd.choice(base).split(" ")
        w[rnd.randrange(120)] = rnd.choice("xyz")
        return " ".join(w)

    train = [(i, variant()) for i in range(60)] + [(60, "a b"), (61, "a b c d e f g h i j")]
    test = [(100 + i, variant()) for i in range(50)] + [(200, "A  b"), (201, "a b c d e f g h i"), (202, None)]
    want = plain(train, test)
    assert any(r[2] > 10 for r in want)
    for name, value in (("HOME_TRAIN", 4), ("HOME_TEST", 3), ("HOME_SHINGLES", 10), ("HELD_ROWS", 20)):
        monkeypatch.setattr(U, name, value)
        assert run(spark, train, test) == want


def test_texts_do_not_move_once_per_pair(spark):
    # One group of near copies, 60 x 60 pairs: what goes to disk follows the texts, not the pairs.
    rnd = random.Random(11)
    words = ["%08x" % rnd.getrandbits(32) for _ in range(1000)]

    def variant():
        w = list(words)
        for at in rnd.sample(range(1000), 3):
            w[at] = "%08x" % rnd.getrandbits(32)
        return " ".join(w)

    train, test = [(i, variant()) for i in range(60)], [(100 + i, variant()) for i in range(60)]

    def on_disk():
        tops = [*spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString(), spark.conf.get("spark.checkpoint.dir")]
        return {p: p.stat().st_size for top in tops for p in Path(top).rglob("*") if p.is_file() and "broadcast" not in p.name}

    before, broadcast = on_disk(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with texts too large for it
    try:
        got = run(spark, train, test)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert [r[:3] for r in got] == [(100 + i, 0, 60) for i in range(60)]
    new = sum(size for p, size in on_disk().items() if p not in before)
    assert new < 4 * sum(len(t) for _, t in train + test)
